"""Rows as files of their own name, written all or not at all, and feeds read one task each.

Both are Python data sources over any file system that pyarrow names by its URI. Their classes are made in functions, so that
workers get them by value and need no installed package.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

FILES = "name string, content string"
FEED_ROWS = "file string, problem string, nth int, title string, link string, summary string, author string, category string, pub_date string"


def _opened():
    """How a task opens a path; a function of its own, so that it travels with what uses it."""

    def opened(path: str):
        import os

        from pyarrow import fs

        return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))

    return opened


def _writer_source() -> type[DataSource]:
    opened = _opened()

    class Written(WriterCommitMessage):
        def __init__(self, files: list[tuple[str, str]]):
            self.files = files

    class Writer(DataSourceWriter):
        """Tasks write below a folder of this run; only the commit moves files to their names, so a failed run leaves what was there."""

        def __init__(self, path: str, run: str):
            self.path, self.run = path, run

        def write(self, rows: Iterator) -> WriterCommitMessage:
            import uuid

            files, root = opened(self.path)
            done = []
            for row in rows:
                name = row["name"]
                if not name or name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"not a file's name below the folder: {name!r}")
                at = f"{root}/{self.run}/{uuid.uuid4().hex}"
                files.create_dir(f"{root}/{self.run}", recursive=True)
                with files.open_output_stream(at) as out:
                    out.write((row["content"] or "").encode())
                done.append((name, at))
            return Written(done)

        def commit(self, messages: list) -> None:
            files, root = opened(self.path)
            pairs = [p for m in messages if m is not None for p in m.files]
            names = [n for n, _ in pairs]
            if len(names) != len(set(names)):
                self.abort(messages)
                raise ValueError("two rows have one file's name: " + ", ".join(sorted({n for n in names if names.count(n) > 1})[:5]))
            for folder in {f"{root}/{n}".rpartition("/")[0] for n in names}:
                files.create_dir(folder, recursive=True)
            for name, at in pairs:
                files.move(at, f"{root}/{name}")
            self._clear(files, root)

        def abort(self, messages: list) -> None:
            self._clear(*opened(self.path))

        def _clear(self, files, root: str) -> None:
            from pyarrow import fs

            if files.get_file_info(f"{root}/{self.run}").type == fs.FileType.Directory:
                files.delete_dir(f"{root}/{self.run}")

    class NamedFiles(DataSource):
        @classmethod
        def name(cls) -> str:
            return "named_files"

        def schema(self) -> str:
            return "name string, content string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            import uuid

            return Writer(self.options["path"], f"_run-{uuid.uuid4().hex}")

    return NamedFiles


def write_named(files: DataFrame, path: str) -> None:
    """Writes each row (name, content) as the file `path`/name; names may have folders. Files of other names stay.

    A file is put in place when all tasks are done, so a failed run changes nothing; what a lost task had written is written again elsewhere, and
    cleared with the run's folder. Two rows of a name are refused.
    """
    spark = files.sparkSession
    spark.dataSource.register(_writer_source())
    files.select(F.col("name").cast("string").alias("name"), F.col("content").cast("string").alias("content")).write.format("named_files").mode("append").option("path", path).save()


def _feed_source() -> type[DataSource]:
    opened = _opened()

    class Feed(InputPartition):
        def __init__(self, file: str):
            super().__init__(file)
            self.file = file

    class Reader(DataSourceReader):
        def __init__(self, path: str):
            self.path = path

        def partitions(self) -> list[InputPartition]:
            from pyarrow import fs

            files, root = opened(self.path)
            found = files.get_file_info(fs.FileSelector(root, recursive=True))
            return [Feed(f.path) for f in sorted(found, key=lambda f: f.path) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            """The feed's items as the parser meets them, and one row for a feed that has none or breaks off, with what is wrong."""
            from xml.etree import ElementTree

            local = lambda tag: tag.rpartition("}")[2] if isinstance(tag, str) else ""
            said = lambda node: None if node is None or not node.text else node.text.strip()
            files, _ = opened(self.path)
            file = partition.file.rpartition("/")[2]
            n, root, problem = 0, None, ""
            with files.open_input_stream(partition.file) as data:
                try:
                    for event, node in ElementTree.iterparse(data, ("start", "end")):
                        root = node if root is None else root
                        if event == "start" or local(node.tag) not in ("item", "entry"):
                            continue
                        of = {local(child.tag): child for child in reversed(node)}
                        link = of.get("link")
                        author = of.get("author") if of.get("author") is not None else of.get("creator")
                        name = next((c for c in author if local(c.tag) == "name"), author) if author is not None else None
                        summary = next((of[x] for x in ("description", "summary", "content") if x in of), None)
                        date = next((of[x] for x in ("pubDate", "updated", "date") if x in of), None)
                        yield file, "", n, said(of.get("title")), None if link is None else link.get("href") or said(link), said(summary), said(name), said(of.get("category")), said(date)
                        n += 1
                        node.clear()
                except ElementTree.ParseError as e:
                    problem = "empty" if root is None and "no element" in str(e) else "not a feed" if root is None else "broken off" if n else "not a feed"
            if not problem and not n:
                problem = "no items" if local(root.tag) in ("rss", "feed", "RDF") else "not a feed"
            if problem:
                yield file, problem, None, None, None, None, None, None, None

    class Feeds(DataSource):
        @classmethod
        def name(cls) -> str:
            return "landed_feeds"

        def schema(self) -> str:
            return "file string, problem string, nth int, title string, link string, summary string, author string, category string, pub_date string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options["path"])

    return Feeds


def read_feed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Items and health of all feeds below a folder from one read: a task reads a feed, streaming over its elements.

    An item (RSS, RDF or Atom) is a row with `nth`, its place; a feed that is empty, has no items, is none or breaks off has one row with a
    `problem`, and what came before the break counts.
    """
    spark.dataSource.register(_feed_source())
    return spark.read.format("landed_feeds").option("path", path).load()


def items_of(rows: DataFrame) -> DataFrame:
    return rows.where("nth IS NOT NULL").drop("problem")


def health_of(rows: DataFrame) -> DataFrame:
    """url (the file's name), number of items and problem of each feed; the problem is empty where there is none."""
    return rows.groupBy(F.col("file").alias("url")).agg(F.count("nth").alias("items"), F.max("problem").alias("problem"))
