"""Table and column discovery.

Works on names and schemas only: no job runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin import schema as S


def pick_table(names: Sequence[str], preferred: str = S.PREFERRED_TABLE,
               patterns: Sequence[str] = S.TABLE_PATTERNS) -> str:
    """The exact preferred name, else the first name containing one of the
    patterns (patterns tried in order), else the first table."""
    names = list(names)
    if not names:
        raise ValueError("no table found")
    if preferred in names:
        return preferred
    for pat in patterns:
        hits = [n for n in names if pat.lower() in n.lower()]
        if hits:
            return hits[0]
    return names[0]


def resolve_mapping(columns: Sequence[str],
                    patterns: Mapping[str, Sequence[str]] = S.COLUMN_PATTERNS) -> dict[str, str | None]:
    """Canonical name -> source column (or None).  Exact (case-insensitive)
    matches win over substring matches; within each pass the synonyms are
    tried in order and the first column in table order wins (decision Q25)."""
    lower = [(c, c.lower()) for c in columns]
    out: dict[str, str | None] = {}
    for canon, names in patterns.items():
        found = None
        for name in names:
            found = next((c for c, lc in lower if lc == name.lower()), None)
            if found:
                break
        if found is None:
            for name in names:
                found = next((c for c, lc in lower if name.lower() in lc), None)
                if found:
                    break
        out[canon] = found
    return out


def resolve_columns(df: DataFrame, patterns: Mapping[str, Sequence[str]] = S.COLUMN_PATTERNS,
                    keep_others: bool = False) -> DataFrame:
    """S3 + S4: select the canonical columns under their canonical names;
    absent counts become 0, other absent columns ''."""
    mapping = resolve_mapping(df.columns, patterns)
    cols = []
    for canon, src in mapping.items():
        if src is not None:
            cols.append(F.col(src).alias(canon))
        elif canon in S.COUNT_COLUMNS:
            cols.append(F.lit(0).cast("long").alias(canon))
        else:
            cols.append(F.lit("").alias(canon))
    if keep_others:
        used = {v for v in mapping.values() if v}
        cols += [F.col(c) for c in df.columns if c not in used and c not in mapping]
    return df.select(*cols)
