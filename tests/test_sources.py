from __future__ import annotations

import io
import time
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears import session
from arrears.operators import shaping
from arrears.sources import archives, pages, tables
from arrears.streaming.landing import land_new_files


def put(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)


@pytest.fixture()
def landing(tmp_path):
    head = "CPF_CNPJ;TIPO_PESSOA;NOME_DEVEDOR;EXTRA"
    many = [f"{i};Pessoa jurídica;nome;x" for i in range(2500)]
    late = "\r\n".join([head, *many, "9;J;João;x"]).encode("latin1")  # first bad byte far behind the first chunk
    put(tmp_path / "2023T1_a_FGTS.zip", {"late.csv": late, "notes.txt": b"no"})
    put(
        tmp_path / "2024T4_b_Nao_Previdenciario.zip",
        {
            "utf8.csv": 'TIPO_PESSOA;"CPF_CNPJ"\nJ;12.345/0001-07\nF;1\n;2\nj;NA\nPJ;1234567890123456\n'.encode(),
            "empty.csv": b"",
            "headonly.csv": b"CPF_CNPJ;TIPO_PESSOA\n",
        },
    )
    (tmp_path / "2022T2_broken.zip").write_bytes(b"this is no archive")
    return str(tmp_path)


def test_members_are_read_whole_and_once(spark, landing):
    members = archives.list_members(spark, landing)
    assert {(r["archive"].rsplit("/")[-1], r["member"]) for r in members.collect()} == {
        ("2023T1_a_FGTS.zip", "late.csv"),
        ("2024T4_b_Nao_Previdenciario.zip", "utf8.csv"),
        ("2024T4_b_Nao_Previdenciario.zip", "empty.csv"),
        ("2024T4_b_Nao_Previdenciario.zip", "headonly.csv"),
    }
    raw = archives.read_members(members, chunk_rows=100)
    assert raw.columns == [*archives.DEBT_COLUMNS, "archive", "member"]
    counts = {r["file"].split("::")[1]: r["n"] for r in archives.rows_by_file(raw).collect()}
    assert counts == {"late.csv": 2501, "utf8.csv": 5}
    names = {r["NOME_DEVEDOR"] for r in raw.filter("member = 'late.csv'").select("NOME_DEVEDOR").distinct().collect()}
    assert names == {"nome", "João"}


def test_harmonised_rows(spark, landing):
    rows = archives.harmonise(archives.read_members(archives.list_members(spark, landing))).filter("ANO = '2024'").collect()
    assert {(r["CNPJ"], r["TRIMESTRE"], r["ORIGEM"], r["FILE_NAME"], r["NOME_DEVEDOR"]) for r in rows} == {
        ("00012345000107", "4", "SIDA", "utf8.csv", None),
        ("1234567890123456", "4", "SIDA", "utf8.csv", None),
    }


def test_a_bad_member_can_fail_the_job(spark, landing):
    members = archives.list_members(spark, landing)
    with pytest.raises(ValueError, match="empty.csv: empty"):
        archives.read_members(members, on_error="raise").count()
    with pytest.raises(ValueError):
        archives.read_members(members, on_error="other")


def test_problems_are_rows_and_half_read_members_vanish(spark, landing, tmp_path):
    put(tmp_path / "2021T1_c_FGTS.zip", {"half.csv": b'CPF_CNPJ;TIPO_PESSOA\n1;J\n2;J\n3;"J\n4;J\n', "ok.csv": b"CPF_CNPJ;TIPO_PESSOA\n5;J\n"})
    table, problems = archives.ingest(spark, landing, str(tmp_path / "out"), chunk_rows=1)
    assert {(r["archive"].rsplit("/")[-1], r["member"], r["rows_read"], r["problem"]) for r in problems.collect()} == {
        ("2022T2_broken.zip", None, 0, "archive"),
        ("2024T4_b_Nao_Previdenciario.zip", "empty.csv", 0, "empty"),
        ("2021T1_c_FGTS.zip", "half.csv", 2, "parse"),
    }
    assert [r["CNPJ"] for r in table.filter("ANO = '2021'").collect()] == ["5".zfill(14)]
    assert table.filter("ANO = '2023'").count() == 2501


def test_small_lots_do_not_make_small_frames(spark, tmp_path):
    """Rows are counted by lots of any size, and lots of one row do not slow the reading of good members."""
    head, lines = "CPF_CNPJ;TIPO_PESSOA\n", [f"{i};J\n" for i in range(30_000)]
    readable = 15_700
    half = "".join([head, *lines[:readable], '1;"J\n', *lines])  # a quote stays open
    put(tmp_path / "2021T1_c_FGTS.zip", {"good.csv": "".join([head, *lines]), "half.csv": half})
    members = archives.list_members(spark, str(tmp_path))
    seconds = {}
    for lot in (100_000, 15_000, 7_000, 1):
        start = time.perf_counter()
        rows, problems = archives.load_members(members, chunk_rows=lot)
        assert rows.count() == 30_000
        seconds[lot] = time.perf_counter() - start
        found = [(r["member"], r["rows_read"], r["problem"]) for r in problems.collect()]
        assert found == [("half.csv", readable // lot * lot, "parse")]
    assert seconds[1] < 3 * seconds[7_000] + 8


def test_a_storage_fault_fails_the_job(spark, landing, tmp_path):
    members = archives.list_members(spark, landing)
    gone = members.withColumn("archive", F.concat("archive", F.lit(".gone")))
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        archives.read_members(gone).count()
    with pytest.raises(Exception, match="FileNotFoundError|No such file"):
        archives.member_columns(gone).count()


def test_store_options_reach_the_file_system():
    conf = session.object_store_conf("k", "s", "http://store.example:9000", "eu-1")
    options = {k.removeprefix(archives.STORE_OPTIONS): v for k, v in conf.items()}
    assert archives.store_arguments(options) == {
        "access_key": "k", "secret_key": "s", "region": "eu-1", "endpoint_override": "store.example:9000", "scheme": "http",
    }
    system, inner = archives._place("s3a://bucket/a.zip", options)
    assert type(system).__name__ == "S3FileSystem" and inner == "bucket/a.zip"
    assert archives.store_arguments({}) == {}


def test_columns_by_file(spark, landing):
    headers = archives.member_columns(archives.list_members(spark, landing)).filter(~F.col("file").endswith("empty.csv"))
    matrix = {r["file"].split("::")[1]: r.asDict() for r in archives.column_matrix(headers).collect()}
    assert set(matrix) == {"late.csv", "utf8.csv", "headonly.csv"}
    assert matrix["late.csv"]["EXTRA"] == 1 and matrix["utf8.csv"]["EXTRA"] == 0 and matrix["utf8.csv"]["CPF_CNPJ"] == 1
    assert [r["column"] for r in archives.common_columns(headers).collect()] == ["CPF_CNPJ", "TIPO_PESSOA"]


def test_links(spark):
    html = """<p><a class="x" href="2023_trimestre_01/Dados.ZIP">a</a> <A HREF='/y/b.csv?x=1&amp;y=2'>b</A>
    <a href="other.html">c</a><a name="q">d</a><a href="https://h.example.net/z/c.zip">e</a></p>"""
    df = spark.createDataFrame([(1, "https://s.example.org/d/page.html", html)], "page_id int, url string, html string")
    rows = {(r["href"], r["file_url"], r["file_name"]) for r in pages.page_links(df, [".zip", ".csv", "y=2"]).collect()}
    assert rows == {
        ("2023_trimestre_01/Dados.ZIP", "https://s.example.org/d/2023_trimestre_01/Dados.ZIP", "2023T1_Dados.ZIP"),
        ("/y/b.csv?x=1&y=2", "https://s.example.org/y/b.csv?x=1&y=2", "b.csv?x=1&y=2"),
        ("https://h.example.net/z/c.zip", "https://h.example.net/z/c.zip", "c.zip"),
    }


def test_files_are_landed_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = T.StructType([T.StructField("id", T.LongType())])
    spark.range(5).write.parquet(source)

    def landed():
        return sorted(r["id"] for r in spark.read.schema(schema).parquet(target).collect())

    for _ in range(2):
        land_new_files(spark, source, schema, target, state)
        assert landed() == [0, 1, 2, 3, 4]
    spark.range(5, 8).write.mode("append").parquet(source)
    land_new_files(spark, source, schema, target, state, lambda d: d.withColumn("id", F.col("id") * 10))
    assert landed() == [0, 1, 2, 3, 4, 50, 60, 70]


def test_alignment(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    one = spark.createDataFrame([(1, "x")], "b int, c string")
    two = spark.createDataFrame([("k",)], "a string")
    got = shaping.union_aligned([one, two], schema)
    assert got.schema == schema and {tuple(r) for r in got.collect()} == {(None, 1), ("k", None)}
    assert shaping.keep_known(one, ["c", "z"]).columns == ["c"]
    assert shaping.add_constants(two, {"n": 1}).first().asDict() == {"a": "k", "n": 1}
    with pytest.raises(ValueError, match="z"):
        shaping.require_columns(two, "a", "z")


def test_column_kinds(spark):
    df = spark.createDataFrame([], "i int, l bigint, d double, s string, b boolean, m decimal(18,2), t date, k string")
    assert shaping.columns_by_type(df, ["k"]) == (["i", "l", "d", "m"], ["s"])


def test_pruned_scan(spark, folder):
    df = tables.read_parquet(spark, f"{folder}/orders.parquet", ["o_orderkey"]).filter("o_orderkey > 10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan and "PushedFilters: [IsNotNull(o_orderkey), GreaterThan" in plan


def test_sorted_files(spark, tmp_path):
    path = str(tmp_path / "sorted")
    tables.write_sorted(spark.range(100).selectExpr("100 - id AS k"), path, ["k"], partitions=4)
    parts = [
        [r["k"] for r in spark.read.parquet(f[0]).collect()]
        for f in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()
    ]
    parts.sort(key=lambda p: p[0])
    assert sum(parts, []) == list(range(1, 101)) and len(parts) > 1


def test_csv_with_inferred_types(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.write_csv(spark.createDataFrame([("Ana", 30)], "nome string, idade int"), path)
    assert tables.read_csv(spark, path).dtypes == [("nome", "string"), ("idade", "int")]


def test_shared_folder(spark):
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.object_store_conf("k", "s", "http://store.example.com")["spark.hadoop.fs.s3a.access.key"] == "k"


def test_decoding_is_decided_on_the_whole_member():
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("good", "ação".encode() * 10)
        z.writestr("bad", b"x" * archives.WINDOW + "é".encode("latin1"))
        z.writestr("cut", b"abc\xc3")
    with zipfile.ZipFile(buffer) as z:
        assert [archives._is_utf8(z, m) for m in ("good", "bad", "cut")] == [True, False, False]


def test_archives_land_once(spark, tmp_path):
    """New archives only; a batch whose commit was lost is done again, without doubling its rows."""
    from arrears.streaming.landing import land_new_archives, landed_rows

    folders = [str(tmp_path / n) for n in ("in", "out", "bad", "state")]
    (tmp_path / "in").mkdir()

    def arrive(name, key):
        with zipfile.ZipFile(tmp_path / "in" / name, "w") as z:
            z.writestr(f"{key}.csv", f'CPF_CNPJ;TIPO_PESSOA;NOME_DEVEDOR\n{key};J;"two\nlines"\n')

    def found():
        return sorted((r.CNPJ.lstrip("0"), r.NOME_DEVEDOR, r.ANO) for r in landed_rows(spark, folders[1]).collect())

    arrive("2023T1_a_FGTS.zip", 11)
    (tmp_path / "in" / "2023T2_broken.zip").write_bytes(b"no archive" * 10)
    land_new_archives(spark, *folders)
    assert found() == [("11", "two\nlines", "2023")]
    arrive("2024T1_b_FGTS.zip", 22)
    land_new_archives(spark, *folders)
    both = [("11", "two\nlines", "2023"), ("22", "two\nlines", "2024")]
    assert found() == both
    for commit in (tmp_path / "state" / "commits").glob("*1*"):
        commit.unlink()  # as if the job had died after it wrote its second batch
    land_new_archives(spark, *folders)
    assert found() == both
    problems = spark.read.parquet(folders[2]).collect()
    assert [(r.archive.rsplit("/", 1)[-1], r.problem) for r in problems] == [("2023T2_broken.zip", "archive")]
