"""Schema conformance: renames, target-schema projection, column aliases, union by name.

All of these are projections decided from schema metadata; they add no job and no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodlens.functions.text import zero_pad

# --- fixed values -----------------------------------------------------------
# Alternate-release (upper-case) column → snapshot column.
ALTERNATE_RENAMES = {
    "AGY": "agy", "AGYSUB": "agysub", "LOC": "loc", "AGELVLT": "agelvlt", "EDLVL": "edlvl",
    "EDLVLT": "edlvlt", "LOS": "los", "OCC": "occ", "OCCFAM": "occfam", "OCCFAMT": "occfamt",
    "OCCT": "occt", "PAYPLAN": "payplan", "PAYPLANT": "payplant", "SUPERVIS": "supervis",
    "SUPERVIST": "supervist", "TOA": "toa", "TOAT": "toat", "WORKSCH": "worksch",
    "WORKSCHT": "wrkscht", "DATECODE": "datecode", "COUNT": "employment", "SALARY": "salary",
    "AGYSUBT": "agysubt", "STATET": "loct",
}
# The 52 snapshot fields in schema order.
SNAPSHOT_FIELDS = (
    "dataset_key", "quarter", "year", "agelvl", "agelvlt", "agy", "agysub", "agysubt", "datecode",
    "edlvl", "edlvlt", "employment", "gsegrd", "loc", "loct", "los", "loslvl", "loslvlt", "occ",
    "occfam", "occfamt", "occt", "occtyp", "occtypt", "patco", "patcot", "pp", "ppt", "payplan",
    "payplant", "pptyp", "ppgroup", "ppgroupt", "ppgrd", "ppgrdt", "salary", "sallvl", "sallvlt",
    "stemocc", "stemocct", "supervis", "supervist", "toa", "toat", "worksch", "wrksch", "wrkscht",
    "wstyp", "wstypt", "workstat", "wkstat", "wkstatt",
)
# Code/description aliases: (source, alias) added when the alias is absent.
COLUMN_ALIASES = (("worksch", "wrksch"), ("workstat", "wkstat"),
                  ("workscht", "wrkscht"), ("workstatt", "wkstatt"))
# ----------------------------------------------------------------------------


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename the mapped columns that exist; others untouched."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def conform(df: DataFrame, target, fill: str | None = "", types: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``target`` column order: missing → ``fill`` literal, extras dropped."""
    types = types or {}
    cols = []
    for name in target:
        t = types.get(name, "string")
        if name in df.columns:
            cols.append(F.col(name).cast(t).alias(name) if name in types else F.col(name))
        else:
            cols.append(F.lit(fill).cast(t).alias(name))
    return df.select(*cols)


def add_aliases(df: DataFrame, pairs=COLUMN_ALIASES) -> DataFrame:
    """Add alias columns (e.g. ``wrksch`` from ``worksch``) where the alias is missing (P5)."""
    add = {alias: F.col(src) for src, alias in pairs if src in df.columns and alias not in df.columns}
    return df.withColumns(add) if add else df


def project_table(df: DataFrame, drop=(), rename: dict | None = None) -> DataFrame:
    """Per-table projection for display: drop columns, rename headers."""
    out = df.drop(*[c for c in drop if c in df.columns])
    return rename_columns(out, rename or {})


def pad_codes(df: DataFrame, columns=("loc",), width: int = 2) -> DataFrame:
    """Zero-pad code columns in place (P4 in the conform step)."""
    return df.withColumns({c: zero_pad(c, width) for c in columns if c in df.columns})


def union_by_name(frames, allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name; columns missing in a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
