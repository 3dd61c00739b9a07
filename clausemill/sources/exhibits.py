"""Whole exhibit files as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from clausemill.session import scratch_path

READ_BYTES = 32 << 20  # of contents that a reading worker holds before it hands them on
LISTED_ROWS = 10_000  # of a folder that a listing worker hands on at a time
LISTED = "path string, length long"


def _file_system(folder: str):
    """The ``pyarrow`` file system of a folder and the folder's path in it."""
    from pyarrow import fs

    plain = folder.rstrip("/")
    return fs.FileSystem.from_uri("file://" + plain[5:] if plain.startswith("file:/") and not plain.startswith("file://") else plain)


def _files(reader, where: str) -> DataFrame:
    # Undecodable bytes become U+FFFD. ``path`` is the decoded path; ``_metadata`` has it escaped.
    return _as_text(reader.load(where)).select("path", "raw")


def _as_text(files: DataFrame) -> DataFrame:
    return files.withColumn("raw", F.make_valid_utf8(F.col("content").cast("string"))).drop("content")


def _listable(folder: str, companies: str = "") -> bool:
    """Whether the tasks can list a folder: a plain one that ``pyarrow.fs`` opens."""
    try:
        _file_system(folder)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return not any(c in folder for c in "*?[{\\") and "/" not in companies


def _root(spark: SparkSession, folder: str) -> str:
    """The folder as Spark's paths of its files begin with it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")


def _expanded(spark: SparkSession, folders: DataFrame, tasks: int, folder: str, root: str) -> str:
    """One level below some folders: where ``path`` and ``length`` are written, without a length for a folder."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = _file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = system.get_file_info(fs.FileSelector(base + path[len(root) :], allow_not_found=True))
                found = [info for info in found if info.type in (fs.FileType.File, fs.FileType.Directory)]
                for at in range(0, len(found), LISTED_ROWS):
                    part = found[at : at + LISTED_ROWS]
                    lengths = [info.size if info.is_file else None for info in part]
                    paths = [f"{path}/{info.base_name}" for info in part]
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])

    place = scratch_path(spark, "listed-folders")
    folders.repartition(tasks).mapInArrow(listed, LISTED).write.parquet(place)
    return place


def _listing(spark: SparkSession, folder: str, companies: str | None) -> DataFrame | None:
    """``path`` and ``length`` of the exhibits below a folder, listed by tasks, one level of folders at a time.

    With ``companies``, the files two levels below the company folders that this glob names; else those at any depth. As
    in any scan, files without content and hidden ones are left out. None where there are none, or where the tasks
    cannot list the folder; Spark's own reader decides then.
    """
    if not _listable(folder, companies or ""):
        return None
    root = _root(spark, folder)
    name = F.element_at(F.split("path", "/"), -1)
    shown = ~name.startswith(".") & (~name.startswith("_") | name.contains("="))
    folders, places = spark.range(1).select(F.lit(root).alias("path")), []
    while count := folders.count():
        places.append(_expanded(spark, folders, min(count, 4 * spark.sparkContext.defaultParallelism), folder, root))
        found = spark.read.schema(LISTED).parquet(places[-1])
        folders = found.where("length IS NULL").select("path")
        if companies is None:
            folders = folders.where(shown)
        elif len(places) == 1:
            glob = spark._jvm.org.apache.hadoop.fs.GlobPattern(companies).compiled().pattern()
            folders = folders.where(name.rlike(f"(?s)^(?:{glob})$"))
        elif len(places) == 3:
            places = places[-1:]
            break
    else:
        if companies is not None:
            return None
    files = spark.read.schema(LISTED).parquet(*places).where(shown & name.endswith(".htm") & (F.col("length") > 0))
    return None if files.isEmpty() else files


def with_path_keys(files: DataFrame) -> DataFrame:
    """Company key, accession number and file name are the last three parts of the path."""
    parts = F.split("path", "/")
    return files.withColumns(
        {
            "cik": F.element_at(parts, -3),
            "accession": F.element_at(parts, -2),
            "filename": F.element_at(parts, -1),
        }
    )


def read_exhibits(spark: SparkSession, folder: str, companies: str = "*") -> DataFrame:
    """Every ``{cik}/{accession}/{filename}.htm`` below a folder, one row per file.

    Files are listed by tasks and dealt to tasks by their bytes; the driver, whose file index would hold them all, does
    not know them. ``companies`` is a glob over company folders.
    """
    listed = _listing(spark, folder, companies)
    if listed is None:
        files = _files(spark.read.format("binaryFile"), f"{folder.rstrip('/')}/{companies}/*/*.htm")
    else:
        files = _read(listed, folder)
    return with_path_keys(files).select("cik", "accession", "filename", "raw")


def list_exhibits(spark: SparkSession, folder: str, companies: str = "*") -> DataFrame:
    """Key and ``length`` in bytes of every exhibit below a folder; no file is opened."""
    files = _listing(spark, folder, companies)
    if files is None:
        files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{companies}/*/*.htm").select("path", "length")
    return with_path_keys(files).select("cik", "accession", "filename", "length")


def _tasks(listed: DataFrame, max_bytes: int | None = None) -> int:
    """How many tasks read what is listed, by its bytes."""
    spark = listed.sparkSession
    read = F.col("length") if max_bytes is None else F.when(F.col("length") <= max_bytes, F.col("length"))
    total, count = listed.agg(F.coalesce(F.sum(read), F.lit(0)), F.count("*")).first()
    split = int(spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b"))
    return int(max(total // split + 1, min(count, spark.sparkContext.defaultParallelism), 1))


def _reader(folder: str, columns: list[str], name: Callable[[dict], str], max_bytes: int | None):
    """For ``mapInArrow``: rows with the ``content`` of the file below the folder that ``name`` gives for a row's ``columns``.

    A worker holds a batch of ``READ_BYTES`` at a time. Files over ``max_bytes`` are not opened.
    """

    def with_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)

        def read(batch: pa.RecordBatch, contents: list[bytes | None], end: int) -> pa.RecordBatch:
            rows = batch.slice(end - len(contents), len(contents))
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(contents, pa.binary())], [*rows.schema.names, "content"])

        for batch in batches:
            contents, held, at = [], 0, 0
            for row in batch.select([*columns, "length"]).to_pylist():
                content = None
                if max_bytes is None or row["length"] <= max_bytes:
                    with system.open_input_stream(f"{base}/{name(row)}") as file:
                        content = file.read()
                contents.append(content)
                held, at = held + len(content or b""), at + 1
                if held >= READ_BYTES:
                    yield read(batch, contents, at)
                    contents, held = [], 0
            if contents:
                yield read(batch, contents, at)

    return with_content


def _read(listed: DataFrame, folder: str) -> DataFrame:
    """``path`` and text of listed files. The list is written in as many files as there are tasks, so the reading is no shuffle."""
    spark, root = listed.sparkSession, _root(listed.sparkSession, folder)
    path = scratch_path(spark, "dealt-exhibits")
    listed.repartition(_tasks(listed)).write.parquet(path)
    dealt = spark.read.schema(LISTED).parquet(path)
    reader = _reader(folder, ["path"], lambda row: row["path"][len(root) + 1 :], None)
    return _as_text(dealt.mapInArrow(reader, f"{LISTED}, content binary")).select("path", "raw")


def read_listed(files: DataFrame, folder: str, max_bytes: int) -> DataFrame:
    """The text of listed exhibits as ``raw``; ``files`` has ``cik, accession, filename, length`` and any others.

    Only what is listed is read. The list is written to the shared folder first; its bytes decide how many tasks the
    reading is dealt to, since by its own size it would be a task or two. A worker holds a batch of ``READ_BYTES`` at a
    time. Files over ``max_bytes`` are not opened and have no text.
    """
    spark = files.sparkSession
    path = scratch_path(spark, "listed-exhibits")
    files.write.parquet(path)
    listed = spark.read.schema(files.schema).parquet(path)
    reader = _reader(folder, ["cik", "accession", "filename"], "{cik}/{accession}/{filename}".format_map, max_bytes)
    schema = StructType([*listed.schema.fields, StructField("content", BinaryType())])
    return _as_text(listed.repartition(_tasks(listed, max_bytes)).mapInArrow(reader, schema)).select(*listed.columns, "raw")


def pack_exhibits(spark: SparkSession, folder: str, out: str, slices: list[str]) -> None:
    """S1 for a corpus of many millions of files: copy them into one table of raw documents.

    The files are copied for one glob of company folders at a time (such as ``["0*", "1*", ...]``), since Spark lists
    those of a folder that only it can open on the driver. Each slice replaces only its own part of the table, so a failed one can be
    repeated. The table is what ``build_corpus`` reads.
    """
    for number, companies in enumerate(slices):
        read_exhibits(spark, folder, companies).write.mode("overwrite").parquet(f"{out.rstrip('/')}/slice={number}")


def read_exhibits_anywhere(spark: SparkSession, folder: str) -> DataFrame:
    """S3: every ``.htm`` file at any depth, keyed by its path; listed and read as in ``read_exhibits``."""
    listed = _listing(spark, folder, None)
    if listed is not None:
        return _read(listed, folder)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.htm")
    return _files(reader, folder)


def write_exhibits(documents: DataFrame, folder: str) -> int:
    """S1 backwards: ``cik, accession, filename, raw`` as one file each, ``{folder}/{cik}/{accession}/{filename}``.

    The tasks write the files of their rows, through ``pyarrow.fs``, and only count them; a repeated task writes the same
    files again. A null ``raw`` gives an empty file. Returns the number of files.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        made, count = set(), 0
        for batch in batches:
            for row in batch.to_pylist():
                place = f"{base}/{row['cik']}/{row['accession']}"
                if place not in made:
                    system.create_dir(place, recursive=True)
                    made.add(place)
                with system.open_output_stream(f"{place}/{row['filename']}") as file:
                    file.write((row["raw"] or "").encode())
                count += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([count], pa.int64())})

    rows = documents.select("cik", "accession", "filename", "raw").where("cik IS NOT NULL AND accession IS NOT NULL AND filename IS NOT NULL")
    return rows.mapInArrow(written, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
