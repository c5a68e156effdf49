"""One file for each row, written where the rows lie: a Python data source with a two-phase commit.

    rows.write.format("docloom_files").mode("append").option("suffix", ".md").save("file:///out")

rows has name and content. Each task writes its files under names of its attempt into a folder of the job that readers
skip; when all tasks are done, the files are renamed to what they are called. A failed task or job leaves nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from docloom.operators.render import render

#: Renames that a commit has under way at once.
RENAMES = 16


def file_system(spark: SparkSession, path: str) -> tuple[object, object]:
    """(file system, path) of the JVM."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def uri(spark: SparkSession, path: str) -> str:
    """A path as all nodes understand it: with the scheme that the session's default gives it."""
    fs, at = file_system(spark, path)
    found = fs.makeQualified(at).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and not found.startswith("file:///") else found


def opened(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """(file system, path) of a Python process."""
    found, at = arrow_fs.FileSystem.from_uri(folder)
    return found, at.rstrip("/")


def file_name(name: str, suffix: str) -> str:
    """What a row's file is called; a name that would leave the folder, or be hidden from readers, is an error."""
    made = f"{name}{suffix}"
    if not name or "/" in made or "\0" in made or made in (".", "..") or made[0] in "._":
        raise ValueError(f"no name for a file: {name!r}")
    return made


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: the folder of its attempt, and the names of the files in it."""

    attempt: str
    names: list[str]


class FileWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.suffix, self.overwrite = options["path"].rstrip("/"), options.get("suffix", ""), overwrite
        self.job = f"_writing-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        fs, folder = opened(self.folder)
        attempt, names = uuid.uuid4().hex, []
        fs.create_dir(f"{folder}/{self.job}/{attempt}", recursive=False)  # an error for a task that outlives its job
        for row in rows:
            if row["name"] is None or row["content"] is None:
                continue
            name = file_name(row["name"], self.suffix)
            with fs.open_output_stream(f"{folder}/{self.job}/{attempt}/{name}") as out:
                out.write(row["content"].encode("utf-8"))
            names.append(name)
        return Written(attempt, names)

    def commit(self, messages: list[Written | None]) -> None:
        """Rename the files of all tasks; with overwrite, files of the suffix that were not written go."""
        fs, folder = opened(self.folder)
        done = [m for m in messages if m is not None]
        names = [n for m in done for n in m.names]
        if len(names) > len(set(names)):
            self.abort(messages)
            raise ValueError(f"rows of one name: {sorted({n for n in names if names.count(n) > 1})[:10]}")
        with ThreadPoolExecutor(RENAMES) as pool:
            list(pool.map(lambda x: fs.move(f"{folder}/{self.job}/{x[0]}/{x[1]}", f"{folder}/{x[1]}"), [(m.attempt, n) for m in done for n in m.names]))
        if self.overwrite:
            held = set(names)
            for old in fs.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True)):
                if old.is_file and old.base_name.endswith(self.suffix) and old.base_name not in held:
                    fs.delete_file(old.path)
        self.clear(fs, folder)

    def abort(self, messages: list[Written | None]) -> None:
        self.clear(*opened(self.folder))

    def clear(self, fs: arrow_fs.FileSystem, folder: str) -> None:
        if fs.get_file_info(f"{folder}/{self.job}").type != arrow_fs.FileType.NotFound:
            fs.delete_dir(f"{folder}/{self.job}")


class FileSink(DataSource):
    """Options: path, a URI that every executor reaches; suffix, put behind each name."""

    @classmethod
    def name(cls) -> str:
        return "docloom_files"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        made = FileWriter(self.options, overwrite)
        fs, folder = opened(made.folder)
        fs.create_dir(f"{folder}/{made.job}", recursive=True)
        return made


def write_texts(rows: DataFrame, folder: str, suffix: str) -> None:
    """Write (name, content) as UTF-8 files name + suffix, over what was there.

    Rows without name or content are left out. Two rows of one name, and names that are no file names, are errors; then
    nothing is written.
    """
    spark = rows.sparkSession
    spark.dataSource.register(FileSink)
    rows.select("name", "content").write.format("docloom_files").mode("append").option("suffix", suffix).save(uri(spark, folder))


def write_trees(trees: DataFrame, folder: str) -> None:
    """Each topic's tree as <topic>.json."""
    write_texts(trees.select(F.col("topic").alias("name"), F.to_json(F.struct("base_url", "pages"), {"ignoreNullFields": "false", "pretty": "true"}).alias("content")), folder, ".json")


def write_markdown(trees: DataFrame, folder: str) -> None:
    """Each topic's tree as <topic>.md; a topic without a readable tree is left out."""
    made = render(trees.where("pages is not null"))
    write_texts(made.select(F.col("topic").alias("name"), F.col("md").alias("content")), folder, ".md")
