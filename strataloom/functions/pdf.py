"""Text of PDF bytes, where a reader is installed."""

from __future__ import annotations

import importlib
import io

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def read_pdf(data: bytes | None) -> str:
    """The text; empty for no bytes, without a reader, or where it fails."""
    if not data:
        return ""
    try:
        return importlib.import_module("pdfminer.high_level").extract_text(io.BytesIO(data)) or ""
    except Exception:  # noqa: BLE001  the optional reader raises many kinds
        return ""


def _read_all(s: pd.Series) -> pd.Series:
    return s.map(read_pdf)


def pdf_text(data: Column) -> Column:
    return F.pandas_udf(_read_all, "string")(data)
