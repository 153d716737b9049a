"""Training-data operators: URL filter, token output, source mixing, WARC
bundles, near-dedup of texts and vectors, chat formatting, quality, language
and benchmark decontamination. Nothing outside this folder imports it."""
