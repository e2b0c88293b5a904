"""Delimited text inside zip archives.

A zip member cannot be inflated in parts, so the unit of work is one member: tasks get
paths only, open the archive where it lies and stream the member in chunks.
What they return is an ordinary DataFrame to be written as Parquet at once.
Large members are only inflated by one task, which cuts them at ends of records;
the blocks are dealt to many tasks to be parsed.
"""

from __future__ import annotations

import codecs
import contextlib
import io
import re
import zipfile
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.functions import text
from arrears.sources.tables import stage, write_parquet

# The columns kept from the source files, in output order.
DEBT_COLUMNS = (
    "CPF_CNPJ",
    "DATA_INSCRICAO",
    "INDICADOR_AJUIZADO",
    "NOME_DEVEDOR",
    "NUMERO_INSCRICAO",
    "SITUACAO_INSCRICAO",
    "TIPO_DEVEDOR",
    "TIPO_PESSOA",
    "TIPO_SITUACAO_INSCRICAO",
    "UNIDADE_RESPONSAVEL",
    "VALOR_CONSOLIDADO",
)
LINEAGE = ("FILE_NAME", "ANO", "TRIMESTRE", "ORIGEM")
CHUNK_ROWS = 100_000  # rows are counted by so many in a member that breaks off
READ_ROWS = 10_000  # rows of a frame
WINDOW = 1 << 20
LARGE = 256 << 20  # bytes, inflated, from which on a member is parsed by many tasks
BLOCK = 8 << 20  # bytes of a block of such a member, but for longer records


SHORTEST = 22  # bytes of an empty archive
STORE_OPTIONS = "spark.hadoop.fs.s3a."


def store_options(spark: SparkSession) -> dict[str, str]:
    """The object-store settings of the session (see ``object_store_conf``), to be handed to tasks."""
    return {k.removeprefix(STORE_OPTIONS): v for k, v in spark.sparkContext.getConf().getAll() if k.startswith(STORE_OPTIONS)}


def store_arguments(options: Mapping[str, str]) -> dict[str, object]:
    """Arguments of the object-store file system. Without a key, the process's own credentials are used."""
    out: dict[str, object] = {}
    for name, given in (("access_key", "access.key"), ("secret_key", "secret.key"), ("region", "endpoint.region")):
        if options.get(given):
            out[name] = options[given]
    if endpoint := options.get("endpoint"):
        scheme, _, host = endpoint.rpartition("://")
        out |= {"endpoint_override": host, "scheme": scheme or "https"}
    if options.get("path.style.access") == "false":
        out["force_virtual_addressing"] = True
    return out


def _place(path: str, options: Mapping[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style location."""
    for scheme in ("s3a://", "s3n://", "s3://"):
        if path.startswith(scheme):
            return fs.S3FileSystem(**store_arguments(options or {})), path[len(scheme) :]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _open_archive(path: str, options: Mapping[str, str] | None = None) -> zipfile.ZipFile:
    system, inner = _place(path, options)
    file = system.open_input_file(inner)
    if file.size() < SHORTEST:
        raise zipfile.BadZipFile("too short")
    file.seek(file.size() - SHORTEST)
    file.read()  # zipfile takes a storage fault at this place for a bad archive
    return zipfile.ZipFile(file)


#: What says that the content is bad. All else (storage, rights, memory) fails the task, and Spark tries again.
BAD_CONTENT = (
    (zipfile.BadZipFile, "archive"),
    (zlib.error, "archive"),
    (EOFError, "archive"),
    (NotImplementedError, "archive"),  # unknown compression
    (pd.errors.EmptyDataError, "empty"),
    (pd.errors.ParserError, "parse"),
)
ENCRYPTED = 1  # flag of a zip member
BAD = tuple(kind for kind, _ in BAD_CONTENT)


def _reason(problem: Exception) -> str:
    return next(name for kind, name in BAD_CONTENT if isinstance(problem, kind))


def survey_members(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """(archive, member, bytes, problem): every matching member of every ``*.zip``, and archives that are none.

    A member that needs a password is a row with a problem.

    Archives are listed by Spark without reading them; only their directories are opened, in tasks. An archive that
    cannot be read fails the job; one that is no archive is a row with a problem and no member.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    return survey_archives(listed.select("path"), suffix)


def survey_archives(archives: DataFrame, suffix: str = ".csv") -> DataFrame:
    """As ``survey_members``, of the archives at the given ``path``."""
    options = store_options(archives.sparkSession)

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    with _open_archive(path, options) as archive:
                        rows += [
                            (path, m.filename, m.file_size, "encrypted" if m.flag_bits & ENCRYPTED else None)
                            for m in archive.infolist()
                            if m.filename.endswith(suffix)
                        ]
                except BAD as problem:
                    rows.append((path, None, None, _reason(problem)))
            yield pd.DataFrame(rows, columns=["archive", "member", "bytes", "problem"], dtype=object)

    return archives.mapInPandas(members, "archive string, member string, bytes bigint, problem string")


def list_members(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """(archive, member, bytes) of every matching member of every archive."""
    return survey_members(spark, folder, suffix).filter(F.col("problem").isNull()).drop("problem")


def _one_task_each(members: DataFrame) -> DataFrame:
    """A task for each member: the rows are tiny but the work is not."""
    listed = stage(members.select("archive", "member"), "members")
    return listed.repartition(max(listed.count(), 1))


def _bare(name: str) -> str:
    """A header field without outer blanks and quotes."""
    return name.strip().strip('"')


def _is_utf8(archive: zipfile.ZipFile, member: str) -> bool:
    """Whether the whole member decodes; decided before any row is emitted."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with archive.open(member) as raw:
            while piece := raw.read(WINDOW):
                decoder.decode(piece)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return False
    return True


def load_members(
    members: DataFrame, columns: Sequence[str] = DEBT_COLUMNS, sep: str = ";", chunk_rows: int = CHUNK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Rows and problems of the members, read once and written to the shared folder.

    Rows hold ``columns`` as text, absent ones null, then archive and member. Problems are (archive, member,
    rows_read, problem): members whose content is bad. Rows read from such a member before it broke are left out;
    ``rows_read`` counts whole lots of ``chunk_rows`` of them. A member is UTF-8 as a whole or else latin1. Storage
    faults fail the job.
    """
    wanted = list(columns)
    fields = [T.StructField(c, T.StringType()) for c in [*wanted, "archive", "member"]]
    schema = T.StructType([*fields, T.StructField("rows_read", T.LongType()), T.StructField("problem", T.StringType())])
    options = store_options(members.sparkSession)

    def pieces(path: str, member: str, sizes: Callable[[int], int]) -> Iterator[pd.DataFrame]:
        """Frames of a member, each of ``sizes(rows before it)`` rows at most."""
        with _open_archive(path, options) as archive:
            encoding = "utf-8" if _is_utf8(archive, member) else "latin1"
            with archive.open(member) as raw:
                text_ = io.TextIOWrapper(raw, encoding=encoding, newline="")
                reader, done = pd.read_csv(text_, sep=sep, dtype=str, usecols=lambda c: _bare(c) in wanted, iterator=True), 0
                with contextlib.suppress(StopIteration):
                    while True:
                        piece = reader.get_chunk(sizes(done))
                        done += len(piece)
                        yield piece

    def good_rows(path: str, member: str, known: int) -> int:
        """Rows of the whole lots before a member's fault; the first ``known`` rows can be read."""
        lots, done = known - known % chunk_rows, 0
        with contextlib.suppress(*BAD):
            for piece in pieces(path, member, lambda done: min(READ_ROWS, lots - done if done < lots else chunk_rows - done % chunk_rows)):
                done += len(piece)
        return done - done % chunk_rows

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, member in zip(batch["archive"], batch["member"]):
                done = 0
                try:
                    for piece in pieces(path, member, lambda done: READ_ROWS):
                        full = piece.rename(columns=_bare).reindex(columns=wanted)
                        full = full.astype(object).where(full.notna(), None)
                        done += len(full)
                        yield full.assign(archive=path, member=member, rows_read=None, problem=None).astype(object)
                except BAD as problem:
                    row = dict.fromkeys(wanted) | {"archive": path, "member": member, "rows_read": good_rows(path, member, done)}
                    yield pd.DataFrame([row | {"problem": _reason(problem)}], dtype=object)[schema.names]

    read_ = stage(_one_task_each(members).mapInPandas(read, schema), "members-read")
    problems = read_.filter(F.col("problem").isNotNull()).select("archive", "member", "rows_read", "problem")
    rows = read_.filter(F.col("problem").isNull()).drop("rows_read", "problem")
    return rows.join(problems.select("archive", "member"), ["archive", "member"], "left_anti").select(*[f.name for f in fields]), problems


def quoted_fields(sep: str) -> re.Pattern:
    """Fields that begin with a quote, to its end or that of the text; quotes inside other fields mean nothing."""
    return re.compile(rb'(?<![^\r\n%b])"[^"]*(?:""[^"]*)*"?' % re.escape(sep.encode()))


def _is_closed(field: bytes) -> bool:
    """Whether a match of ``quoted_fields`` ends with its closing quote."""
    return len(field) > 1 and (len(field) - len(field.rstrip(b'"'))) % 2 == (0 if field.strip(b'"') == b"" else 1)


def _line_end(data: bytes, begin: int, end: int, last: bool) -> int:
    """Place behind the last (or first) line break between two places, -1 if there is none.

    Carriage returns count only where no line feed is, and not as the very last byte, which may be half of a break.
    """
    find = data.rfind if last else data.find
    if (at := find(b"\n", begin, end)) < 0:
        at = find(b"\r", begin, min(end, len(data) - 1))
    return at + 1 if at >= 0 else -1


def record_end(data: bytes, fields: re.Pattern, last: bool = True) -> int:
    """Place behind the last (or first) line break outside quotes of a text that begins with a record; -1 if none."""
    if b'"' not in data:
        return _line_end(data, 0, len(data), last)
    gaps, begin = [], 0
    for match in fields.finditer(data):
        gaps.append((begin, match.start()))
        begin = match.end()
        if not last and (at := _line_end(data, *gaps[-1], last)) >= 0:
            return at
        if begin == len(data) and not _is_closed(match[0]):
            break
    else:
        gaps.append((begin, len(data)))
    for begin, end in reversed(gaps) if last else gaps:
        if (at := _line_end(data, begin, end, last)) >= 0:
            return at
    return -1


def record_blocks(raw: io.BufferedIOBase, size: int, sep: str) -> Iterator[bytes]:
    """First the header (the first record), then blocks of whole records, of about ``size`` bytes or one record.

    A buffer without an end of a record is looked at again when it has doubled, so long records take linear time.
    """
    fields, held, wanted, header = quoted_fields(sep), bytearray(), size, False
    while piece := raw.read(WINDOW):
        held += piece
        if not header:
            held = held.lstrip(b"\r\n")
        if len(held) < wanted:
            continue
        data = bytes(held)
        if not header and (at := record_end(data, fields, last=False)) >= 0:
            yield data[:at]
            data, header = data[at:], True
        at = record_end(data, fields) if header else -1
        if at >= 0:
            yield data[:at]
            data = data[at:]
        held, wanted = bytearray(data), max(size, 2 * len(data))
    data = bytes(held)
    if not header:
        at = record_end(data, fields, last=False)
        at = at if at >= 0 else len(data)
        yield data[:at]
        data = data[at:]
    if data:
        yield data


def load_large_members(
    members: DataFrame, columns: Sequence[str] = DEBT_COLUMNS, sep: str = ";", block_bytes: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """As ``load_members``, with the parsing of each member dealt to many tasks.

    One task inflates a member, decides its encoding and cuts it behind records; it parses nothing. Blocks carry the
    header and are read by themselves. What a row has beyond the header's fields is left out, wherever it stands.
    ``rows_read`` counts the rows of a bad member's good blocks; none of them are kept.
    """
    wanted = list(columns)
    options = store_options(members.sparkSession)
    raw_schema = "archive string, member string, header binary, block bigint, body binary, utf8 boolean, problem string"
    names = [x.split()[0] for x in raw_schema.split(", ")]

    def inflate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(*values):
            return pd.DataFrame([values], columns=names, dtype=object)

        for batch in batches:
            for path, member in zip(batch["archive"], batch["member"]):
                decoder, utf8, problem = codecs.getincrementaldecoder("utf-8")(), True, None
                try:
                    with _open_archive(path, options) as archive, archive.open(member) as raw:
                        header = None
                        for number, body in enumerate(record_blocks(raw, block_bytes, sep)):
                            if utf8:
                                try:
                                    decoder.decode(body)
                                except UnicodeDecodeError:
                                    utf8 = False
                            if header is None:
                                header = body
                            yield row(path, member, header, number, b"" if number == 0 else body, None, None)
                        if utf8:
                            try:
                                decoder.decode(b"", final=True)
                            except UnicodeDecodeError:
                                utf8 = False
                except BAD as found:
                    problem = _reason(found)
                yield row(path, member, None, None, None, utf8, problem)

    fields = [T.StructField(c, T.StringType()) for c in [*wanted, "archive", "member"]]
    schema = T.StructType([*fields, T.StructField("rows_read", T.LongType()), T.StructField("problem", T.StringType())])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, member, header, body, utf8 in batch[["archive", "member", "header", "body", "utf8"]].itertuples(index=False):
                encoding = "utf-8" if utf8 else "latin1"
                how = {"sep": sep, "dtype": str, "encoding": encoding}
                try:
                    width = len(pd.read_csv(io.BytesIO(header), nrows=0, **how).columns)
                    blank = sep.join(['""'] * width).encode()  # a row that fixes the number of fields, so that none becomes an index
                    text_ = header.rstrip(b"\r\n") + b"\n" + blank + b"\n" + body
                    piece = pd.read_csv(io.BytesIO(text_), usecols=lambda c: _bare(c) in wanted, **how).iloc[1:]
                    full = piece.rename(columns=_bare).reindex(columns=wanted)
                    full = full.astype(object).where(full.notna(), None)
                    yield full.assign(archive=path, member=member, rows_read=None, problem=None).astype(object)
                except BAD as found:
                    row = dict.fromkeys(wanted) | {"archive": path, "member": member, "problem": _reason(found)}
                    yield pd.DataFrame([row], dtype=object).reindex(columns=schema.names).astype(object)

    inflated = _one_task_each(members).mapInPandas(inflate, raw_schema)
    spread = F.pmod(F.xxhash64("archive", "member", "block"), F.lit(members.sparkSession.sparkContext.defaultParallelism * 4))
    blocks = stage(inflated.repartition(spread), "member-blocks")
    verdicts = stage(blocks.filter("block IS NULL").select("archive", "member", "utf8", "problem"), "member-verdicts")
    whole = verdicts.filter("problem IS NULL").select("archive", "member", "utf8")
    bodies = blocks.filter("block IS NOT NULL").select("archive", "member", "header", "body")
    read_ = stage(bodies.join(whole, ["archive", "member"]).mapInPandas(parse, schema), "blocks-read")
    bad = read_.filter("problem IS NOT NULL").groupBy("archive", "member").agg(F.min("problem").alias("problem"))
    rows = read_.filter("problem IS NULL").drop("rows_read", "problem")
    counts = rows.join(bad, ["archive", "member"], "left_semi").groupBy("archive", "member").agg(F.count(F.lit(1)).alias("rows_read"))
    parsed = bad.join(counts, ["archive", "member"], "left").select(
        "archive", "member", F.coalesce("rows_read", F.lit(0)).alias("rows_read"), "problem"
    )
    broken = verdicts.filter("problem IS NOT NULL").select("archive", "member", F.lit(0).cast("long").alias("rows_read"), "problem")
    kept = rows.join(bad.select("archive", "member"), ["archive", "member"], "left_anti")
    return kept.select(*[f.name for f in fields]), stage(broken.unionByName(parsed), "member-problems")


def read_members(
    members: DataFrame,
    columns: Sequence[str] = DEBT_COLUMNS,
    sep: str = ";",
    chunk_rows: int = CHUNK_ROWS,
    on_error: str = "skip",
) -> DataFrame:
    """The rows of ``load_members``. ``on_error="raise"``: a member with bad content ends the job."""
    if on_error not in ("skip", "raise"):
        raise ValueError("on_error must be 'skip' or 'raise'")
    rows, problems = load_members(members, columns, sep, chunk_rows)
    if on_error == "raise" and (first := problems.first()):
        raise ValueError(f"{first['archive']}::{first['member']}: {first['problem']} (after {first['rows_read']} rows)")
    return rows


def ingest(
    spark: SparkSession, folder: str, target: str, chunk_rows: int = CHUNK_ROWS, large: int = LARGE
) -> tuple[DataFrame, DataFrame]:
    """Archives to one table at ``target``, by year and quarter; returns the table read back, and the problems.

    Problems are those of archives (no member) and of members. Members of ``large`` bytes and more are parsed by many
    tasks each.
    """
    table, bad = tables_of(survey_members(spark, folder), chunk_rows, large)
    write_parquet(table, target, ["ANO", "TRIMESTRE"])
    return spark.read.schema(table.schema).parquet(target).select(*table.columns), bad


def tables_of(survey: DataFrame, chunk_rows: int = CHUNK_ROWS, large: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """The harmonised rows of surveyed members, and all problems (archive, member, rows_read, problem)."""
    survey = stage(survey, "archive-survey")
    good = survey.filter(F.col("problem").isNull())
    big = good.filter(F.col("bytes") >= large)
    if big.isEmpty():
        rows, problems = load_members(good, chunk_rows=chunk_rows)
    else:
        rows, problems = load_large_members(big)
        more, worse = load_members(good.filter(F.col("bytes") < large), chunk_rows=chunk_rows)
        rows, problems = rows.unionByName(more), problems.unionByName(worse)
    bad = survey.filter(F.col("problem").isNotNull()).select("archive", "member", F.lit(0).cast("long").alias("rows_read"), "problem")
    return harmonise(rows), bad.unionByName(problems)


def member_columns(members: DataFrame, sep: str = ";") -> DataFrame:
    """(file, column) for every header field; ``file`` is ``archive::member``. Reads one line each."""
    options = store_options(members.sparkSession)

    def first_line(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, member in zip(batch["archive"], batch["member"]):
                with contextlib.suppress(*BAD), _open_archive(path, options) as archive, archive.open(member) as raw:
                    rows.append((path, member, raw.readline()))  # bad content is a problem of load_members
            yield pd.DataFrame(rows, columns=["archive", "member", "line"], dtype=object)

    lines = _one_task_each(members).mapInPandas(first_line, "archive string, member string, line binary")
    header = F.btrim(text.decode_with_fallback(F.col("line")), F.lit(" \t\r\n"))
    return lines.select(
        F.concat_ws("::", text.base_name(F.col("archive")), F.col("member")).alias("file"),
        F.explode(F.array_distinct(text.header_fields(header, sep))).alias("column"),
    )


def column_matrix(headers: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per file, one 0/1 column per column name in name order."""
    if columns is None:
        # distinct header names: the width of the result
        columns = sorted(r["column"] for r in headers.select("column").distinct().collect())
    return headers.groupBy("file").agg(
        *[F.max(F.when(F.col("column") == c, 1).otherwise(0)).alias(c) for c in columns]
    )


def common_columns(headers: DataFrame) -> DataFrame:
    """(column): the names every file has, in order."""
    files = headers.agg(F.count_distinct("file").alias("files"))
    held = headers.groupBy("column").agg(F.count_distinct("file").alias("n"))
    return held.join(F.broadcast(files), F.col("n") == F.col("files")).select("column").orderBy("column")


def harmonise(raw: DataFrame) -> DataFrame:
    """Company debts only: the kept columns, the normalised id and where each row came from."""
    name = text.base_name(F.col("archive"))
    return (
        raw.withColumn("CNPJ", text.company_id(F.col("CPF_CNPJ"), F.col("TIPO_PESSOA")))
        .filter(F.col("CNPJ").isNotNull())
        .select(
            *DEBT_COLUMNS,
            "CNPJ",
            F.col("member").alias("FILE_NAME"),
            text.snapshot_year(name).alias("ANO"),
            text.snapshot_quarter(name).alias("TRIMESTRE"),
            text.origin_of(name).alias("ORIGEM"),
        )
    )


def rows_by_file(raw: DataFrame) -> DataFrame:
    """(file, n): rows read, before any filter."""
    return raw.groupBy(F.concat_ws("::", text.base_name(F.col("archive")), F.col("member")).alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )
