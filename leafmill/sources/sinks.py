"""Writers: page files, snapshots, reports and logs. Tables are written through Spark's commit protocol; single files by rename."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A Parquet table (rel_path, content)."""
    pages.select("rel_path", "content").write.mode(mode).parquet(path)


def write_page_files(pages: DataFrame, folder: str) -> None:
    """One UTF-8 file with LF ends per page below a folder that all executors share; a page that can't be written fails its task."""

    def put(rows):
        for r in rows:
            target = os.path.join(folder, r["rel_path"])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            _replace(target, (r["content"] or "").replace("\r\n", "\n"))

    pages.select("rel_path", "content").foreachPartition(put)


def _replace(target: str, content: str | bytes) -> None:
    handle, temp = tempfile.mkstemp(dir=os.path.dirname(target) or ".", suffix=".part")
    with os.fdopen(handle, "wb") as f:
        f.write(content.encode("utf-8", "surrogatepass") if isinstance(content, str) else content)
    os.replace(temp, target)


def fetch_attachments(plan: DataFrame, folder: str, fetch: Callable[[str], bytes]) -> DataFrame:
    """(doc, url, file_name, ok, error): fetches the planned files (doc, url, file_name) into one folder per document below a folder that all executors share.

    A file that exists and isn't empty is a success and isn't fetched again; others are written beside and renamed, so that no half file stays under its name. A failing file fails alone.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for doc, url, name in zip(pdf["doc"], pdf["url"], pdf["file_name"]):
                target, error = os.path.join(folder, str(doc), name), None
                if not (os.path.isfile(target) and os.path.getsize(target)):
                    try:
                        os.makedirs(os.path.dirname(target), exist_ok=True)
                        _replace(target, fetch(url))
                    except Exception as e:  # noqa: BLE001 - the error is the file's status
                        error = str(e) or type(e).__name__
                rows.append((str(doc), url, name, error is None, error))
            yield pd.DataFrame(rows, columns=["doc", "url", "file_name", "ok", "error"])

    return plan.select("doc", "url", "file_name").mapInPandas(run, "doc string, url string, file_name string, ok boolean, error string")


def write_snapshot(text: str, target: str) -> None:
    """A snapshot file, replaced as a whole."""
    os.makedirs(os.path.dirname(os.path.abspath(target)), exist_ok=True)
    _replace(os.path.abspath(target), text)


def snapshot_due(pages_done: int, every: int = 20) -> bool:
    """Whether a periodic snapshot is due; never for ``every`` of 0 or less."""
    return every > 0 and pages_done > 0 and pages_done % every == 0


def write_failures(failures: DataFrame, path: str) -> bool:
    """The failure report as JSON; nothing is written, and an old report stays, if nothing failed."""
    if failures.isEmpty():
        return False
    failures.write.mode("overwrite").json(path)
    return True


def append_failures(failures: DataFrame, path: str) -> None:
    failures.write.mode("append").json(path)


def append_lines(lines: DataFrame, path: str) -> None:
    lines.select(F.col("line").alias("value")).write.mode("append").text(path)
