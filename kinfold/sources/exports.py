"""Small results for people: CSV, JSON samples and one HTML page."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str) -> None:
    """The whole table as CSV files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_json_sample(df: DataFrame, path: str, rows: int = 1000) -> dict:
    """{count, columns, sample}: a look into a dataset, not the dataset."""
    out = {"count": df.count(), "columns": df.columns, "sample": [json.loads(x) for x in df.limit(rows).toJSON().collect()]}
    Path(path).write_text(json.dumps(out, ensure_ascii=False, indent=1))
    return out


def html_report(title: str, tables: dict[str, DataFrame], path: str, rows: int = 100) -> None:
    """Tables of aggregates on one page; of each at most `rows` rows are shown."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in df.limit(rows).collect())
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    Path(path).write_text("\n".join(parts))
