"""Row identity and deterministic ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import qcol, text_or_empty

# Source coordinates appended to the hashed payload, in order.
HASH_COORDINATES = ("_src_file", "_src_sheet", "_src_row")
# Fixed value: UUID namespace for deterministic file base ids (RFC 4122 URL
# namespace). The namespace the registry used is not recorded; this is our
# documented assumption.
BASEID_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def row_payload(columns: Sequence[str]) -> Column:
    """``c1=v1|c2=v2|...`` over the given columns in order; null -> ""."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), text_or_empty(qcol(c))) for c in columns])


def row_hash(data_columns: Sequence[str], coordinates: Sequence[str] = HASH_COORDINATES) -> Column:
    """Sha-256 hex of the payload over the original data headers in sheet
    order, then the source file, sheet and row. Batch stamps are excluded, so
    re-depositing the same workbook reproduces the same hashes."""
    return F.sha2(row_payload(list(data_columns) + list(coordinates)), 256)


def row_hash_from_map(headers, cells, coordinates: Sequence[str] = HASH_COORDINATES) -> Column:
    """P2 for the landing form: ``headers`` is the ordered header array and
    ``cells`` a map header -> text. Coordinates are ordinary columns."""
    h = F.col(headers) if isinstance(headers, str) else headers
    m = F.col(cells) if isinstance(cells, str) else cells
    data = F.transform(h, lambda x: F.concat(x, F.lit("="), F.coalesce(F.element_at(m, x), F.lit(""))))
    coords = F.array(*[F.concat(F.lit(f"{c}="), text_or_empty(qcol(c))) for c in coordinates])
    return F.sha2(F.array_join(F.concat(data, coords), "|"), 256)


def uuid5(name, namespace_hex: str = BASEID_NAMESPACE_HEX) -> Column:
    """RFC 4122 version-5 UUID of a name, equal to ``uuid.uuid5``.

    sha-1 over namespace bytes + UTF-8 name, first 16 bytes, version nibble 5,
    variant bits 10.
    """
    n = F.col(name) if isinstance(name, str) else name
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(n, "UTF-8")))
    variant_nibble = F.lower(F.hex(
        (F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))).bitwiseOR(F.lit(8))))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant_nibble, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
