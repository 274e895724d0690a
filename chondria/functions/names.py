"""Reversible encoding of column names for document stores that restrict field names."""

import re

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values ------------------------------------------------------------------------------
ESCAPE = "$"
LEADING = ("_", "-", "+", ESCAPE)
SPECIAL = {
    ".": "_$dot$_", ",": "_$comma$_", "#": "_$hash$_", "*": "_$star$_", "(": "_$lp$_", ")": "_$rp$_",
    "[": "_$lsb$_", "]": "_$rsb$_", "{": "_$lcb$_", "}": "_$rcb$_",
}

_CODES = {ESCAPE: ESCAPE * 2, **SPECIAL}
_BACK = {code: char for char, code in _CODES.items()}
_TOKEN = re.compile("|".join(re.escape(code) for code in _BACK))


def encode_name(name: str) -> str:
    out = name.translate(str.maketrans(_CODES))
    return ESCAPE + out if out.startswith(LEADING) else out


def decode_name(name: str) -> str:
    return _TOKEN.sub(lambda m: _BACK[m.group()], name.removeprefix(ESCAPE))


def encode_columns(df: DataFrame, dot: str | None = "_") -> DataFrame:
    """Rename the top-level columns; ``dot`` replaces full stops for good, ``None`` keeps them reversible."""
    plain = {c: c if dot is None else c.replace(".", dot) for c in df.columns}
    if len(set(plain.values())) < len(plain):
        raise ValueError(f"names that differ only in full stops: {sorted(df.columns)}")
    return df.withColumnsRenamed({c: encode_name(p) for c, p in plain.items() if encode_name(p) != c})


def decode_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: decode_name(c) for c in df.columns if decode_name(c) != c})


def encoded_text(c: Column) -> Column:
    """:func:`encode_name` for field names that are data."""
    for char, code in _CODES.items():       # the escape itself comes first
        c = F.replace(c, F.lit(char), F.lit(code))
    bad = F.substring(c, 1, 1).isin(list(LEADING))
    return F.when(bad, F.concat(F.lit(ESCAPE), c)).otherwise(c)


def decoded_text(c: Column) -> Column:
    """:func:`decode_name` for field names that are data."""
    c = F.when(c.startswith(ESCAPE), F.substring(c, 2, 2 ** 31 - 1)).otherwise(c)
    for char, code in reversed(_CODES.items()):
        c = F.replace(c, F.lit(code), F.lit(char))
    return c
