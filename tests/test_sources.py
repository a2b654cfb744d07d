import json
import random
import re
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimkeep.operators.merge import ACTION
from dimkeep.plans.model import schema_of
from dimkeep.session import Scratch
from dimkeep.sources.delimited import read_delimited
from dimkeep.sources.files import Files
from dimkeep.sources.sections import parse_sections, read_lines, section_columns
from dimkeep.sources.staging import select_renamed, typed, with_load_date
from dimkeep.sources.store import Store

GOLDEN = """1;extract;20260901
4;LOST;1;before any header
2;Cprnr;Skolekode;Skolenavn;Fradato;Tildato;;
4;P0001;100;North €;20250801;20260731;;
4;P0002;;Søuth;20250801
3;2

2;Cprnr;Feltnavn;Feltvaerdi
7;P0001;bus;yes;100
7;P0002;bus;
3;2
2;Cprnr;Haendelsestype;Dato
3;0
"""

REPO = Path(__file__).resolve().parent.parent


def write(path, text):
    path.write_bytes(text.encode("windows-1252"))
    return str(path)


def scratch(spark, tmp_path):
    return Scratch(spark, str(tmp_path / "kept"))


def in_order(dicts):
    return sorted(dicts, key=lambda d: repr(sorted(d.items())))


def as_dicts(df):
    return in_order({k: v for k, v in r.asDict().items() if v is not None} for r in df.collect())


def test_golden_sections(spark, tmp_path):
    lines = read_lines(spark, write(tmp_path / "h.csv", GOLDEN), scratch(spark, tmp_path))
    parsed = parse_sections(lines)
    assert parsed.columns == [
        "row_type", "Cprnr", "Skolekode", "Skolenavn", "Fradato", "Tildato", "Feltnavn", "Feltvaerdi", "_extra_3"
    ]
    assert as_dicts(parsed) == in_order(
        [
            dict(row_type="4", Cprnr="P0001", Skolekode="100", Skolenavn="North €", Fradato="20250801", Tildato="20260731"),
            dict(row_type="4", Cprnr="P0002", Skolenavn="Søuth", Fradato="20250801"),
            dict(row_type="7", Cprnr="P0001", Feltnavn="bus", Feltvaerdi="yes", _extra_3="100"),
            dict(row_type="7", Cprnr="P0002", Feltnavn="bus"),
        ]
    )
    staged = select_renamed(parsed, {"Skolekode": "school_code", "Cprnr": "cpr_nr", "_extra_3": "school_code"})
    assert [r.school_code for r in staged.collect() if r.cpr_nr == "P0001"].count(None) == 1


def test_wanted_columns_need_no_lookup(spark, tmp_path):
    lines = read_lines(spark, write(tmp_path / "h.csv", GOLDEN), scratch(spark, tmp_path))
    parsed = parse_sections(lines, ["Feltnavn", "Nowhere"])
    assert parsed.columns == ["row_type", "Feltnavn", "Nowhere"] and parsed.count() == 4
    assert {r.Nowhere for r in parsed.collect()} == {None}


def lines_frame(spark, files):
    data = [(path, i, line) for path, text in files.items() for i, line in enumerate(text)]
    return spark.createDataFrame(data, "path string, ln bigint, line string").repartition(3)


def test_first_line_is_never_a_header(spark):
    assert parse_sections(lines_frame(spark, {"a": ["2;A", "4;x"]}), ["A"]).count() == 0


def test_sum_lines_white_space_and_empty_cells(spark):
    lines = lines_frame(spark, {"a": ["m", "2;A;B", "3;9", "   ", "4; x ;", ";y", "33;z"]})
    got = sorted([tuple(r) for r in parse_sections(lines, ["A", "B"]).collect()], key=repr)
    assert got == sorted([("4", " x ", None), (None, "y", None), ("33", "z", None)], key=repr)


def test_widening_ignores_blank_cells(spark):
    lines = lines_frame(spark, {"a": ["m", "2;A;; ", "4;x;1; ;", "5;y"], "b": ["m", "2;A", "4;x; ; "]})
    assert section_columns(lines) == ["A", "_extra_1"]
    got = sorted([tuple(r) for r in parse_sections(lines).collect()], key=repr)
    assert got == sorted([("4", "x", "1"), ("5", "y", None), ("4", "x", None)], key=repr)


def brute_force(files):
    """All cells of all rows by name, one file and one line after the other."""
    out = []
    for text in files.values():
        section, sections_ = None, []
        for line in text[1:]:
            kind, *cells = line.split(";")
            if not line.strip():
                continue
            if kind == "2":
                section = (cells, [])
                sections_.append(section)
            elif kind != "3" and section:
                section[1].append((kind, cells))
        for names, rows in sections_:
            known = max((i + 1 for i, n in enumerate(names) if n.strip()), default=0)
            reach = max((i + 1 for _, cells in rows for i, c in enumerate(cells) if c.strip()), default=0)
            full = names[:known] + [f"_extra_{i}" for i in range(known, reach)]
            for kind, cells in rows:
                row = {n: c for n, c in zip(full, cells) if c != "" and n}
                out.append({"row_type": kind, **row} if kind else row)
    return in_order(out)


@pytest.mark.parametrize("seed", range(4))
def test_random_files(spark, seed):
    rng = random.Random(seed)
    files = {}
    for f in range(4):
        text = ["1;meta"]
        for _ in range(rng.randint(0, 60)):
            what = rng.random()
            if what < 0.12:
                text.append("2;" + ";".join(rng.sample(["A", "B", "C", "D", "E"], rng.randint(1, 4))) + ";" * rng.randint(0, 2))
            elif what < 0.2:
                text.append(rng.choice(["3;1", "", "  "]))
            else:
                text.append(";".join([rng.choice(["4", "5", "6"])] + [rng.choice(["", " ", "x", "yy"]) for _ in range(rng.randint(0, 6))]))
        files[f"f{f}"] = text
    parsed = parse_sections(lines_frame(spark, files))
    assert as_dicts(parsed) == brute_force(files)


def test_a_file_read_in_many_splits(spark, tmp_path):
    body = ["1;meta"]
    for part in range(10, 50):
        body.append(f"2;N{part % 3};V")
        body += [f"{part};{part};{i}" for i in range(50)]
    path = write(tmp_path / "big.csv", "\r\n".join(body))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = read_lines(spark, path, scratch(spark, tmp_path))
        assert lines.select("start").distinct().count() > 5
        parsed = parse_sections(lines, ["N0", "N1", "N2", "V"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(parsed) == 2000
    assert all(r[f"N{int(r.row_type) % 3}"] == r.row_type for r in parsed)


def test_lines_are_not_shuffled_for_few_headers(spark, tmp_path):
    lines = read_lines(spark, write(tmp_path / "h.csv", GOLDEN), scratch(spark, tmp_path))
    parsed = parse_sections(lines, ["Cprnr", "Feltnavn"])
    parsed.collect()
    final = parsed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


@pytest.mark.parametrize("before, after", [(4, 4), (4, 16), (16, 4), (2, 32)])
def test_parallelism_may_change_between_building_and_running(spark, tmp_path, before, after):
    body = ["1;meta", "2;A;B"] + [f"4;{i};x" for i in range(60_000)] + ["2;A;C"] + [f"5;{i};y" for i in range(60_000)]
    path = write(tmp_path / "big.csv", "\n".join(body))
    setting = "spark.sql.leafNodeDefaultParallelism"
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        spark.conf.set(setting, before)
        parsed = parse_sections(read_lines(spark, path, scratch(spark, tmp_path)), ["A", "B", "C"])
        spark.conf.set(setting, after)
        found = {r.row_type: tuple(r)[1:] for r in parsed.groupBy("row_type").agg(F.count("A"), F.count("B"), F.count("C")).collect()}
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {"4": (60_000, 60_000, 0), "5": (60_000, 0, 60_000)}


def test_a_file_of_very_many_sections(spark, tmp_path):
    """The header is carried within and over blocks, from files in splits and from numbered lines alike."""
    names = ["A", "B", "C"]
    body = ["2;not;a;header"] + [text for i in range(100_000) for text in (f"2;{names[i % 3]};X", f"4;{i};{i % 7}", "3;1")]
    want = {"A": 33_334, "B": 33_333, "C": 33_333, "X": 100_000}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")  # many splits
    try:
        from_file = read_lines(spark, write(tmp_path / "many.csv", "\n".join(body)), scratch(spark, tmp_path))
        assert from_file.select("start").distinct().count() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    numbered = spark.createDataFrame(list(enumerate(body)), "ln long, line string").withColumn("path", F.lit("x"))
    for lines in (from_file, numbered.repartition(7)):
        parsed = parse_sections(lines, [*names, "X"])
        assert parsed.agg(*[F.count(n).alias(n) for n in (*names, "X")]).first().asDict() == want
        right = F.when(F.col("A").isNotNull(), 0).when(F.col("B").isNotNull(), 1).otherwise(2)
        number = F.coalesce("A", "B", "C").cast("int")
        assert parsed.where((number % 3 != right) | (number % 7 != F.col("X").cast("int"))).isEmpty()
        assert "collect_list" not in parsed._jdf.queryExecution().optimizedPlan().toString()


def test_a_section_over_many_blocks(spark, tmp_path):
    body = ["1;meta", "4;before;any"] + ["2;A"] + [f"4;{i}" for i in range(200_000)] + ["2;B", "5;last"]
    numbered = spark.createDataFrame(list(enumerate(body)), "ln long, line string").withColumn("path", F.lit("x"))
    got = parse_sections(numbered.repartition(3), ["A", "B"])
    assert got.agg(F.count("A"), F.count("B"), F.countDistinct("A")).first() == (200_000, 1, 200_000)


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_lines(spark, str(tmp_path / "none.csv"), scratch(spark, tmp_path))


# -- delimited ------------------------------------------------------------------


def test_delimited(spark, tmp_path):
    path = write(tmp_path / "b.csv", 'a;b;fødselsdato\r\n1;"x;y";€\r\n2;;""\r\n3; NA\r\n\r\n4;"q""q;;;";z\r\n')
    df = read_delimited(spark, path)
    assert df.columns == ["a", "b", "fødselsdato"] and df.count() == 4
    assert [tuple(r) for r in df.collect()] == [
        ("1", "x;y", "€"), ("2", None, None), ("3", " NA", None), ("4", 'q"q;;;', "z")
    ]


@pytest.mark.parametrize("multi_line", [None, True])
def test_quoted_line_break(spark, tmp_path, multi_line):
    path = write(tmp_path / "b.csv", 'a;b\n1;"x\ny"\n')
    assert [tuple(r) for r in read_delimited(spark, path, multi_line=multi_line).collect()] == [("1", "x\ny")]
    with pytest.raises(ValueError, match="quoted line break"):
        read_delimited(spark, path, multi_line=False)


def test_an_open_quote_yields_no_rows(spark, tmp_path):
    with pytest.raises(ValueError, match="not closed"):
        read_delimited(spark, write(tmp_path / "b.csv", 'a;b\n1;"x\n2;y\n'))


def test_one_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path):
    """The same rows as from the file read whole, wherever splits fall: inside quotes, at their ends, over many lines."""
    draw = random.Random(3)
    cell = lambda: draw.choice(["x", "", '"a;b"', '"p\nq"', '"\n"', '"""\n"""', '"1\n\n2\n3;4"', '"' + "long\n" * draw.randrange(400) + '"', "€ ø"])
    body = ["id;b;c"] + [f"{i};{cell()};{cell()}" for i in range(3000)]
    path = write(tmp_path / "quoted.csv", "\n".join(body))
    reader = spark.read.option("sep", ";").option("header", True).option("encoding", "windows-1252").option("escape", '"')
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    whole = sorted(tuple(r) for r in reader.option("multiLine", True).option("nullValue", "").csv(path).collect())
    spark.conf.unset("spark.sql.legacy.javaCharsets")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        kept = scratch(spark, tmp_path)
        got = read_delimited(spark, path, scratch=kept)
        lines = spark.read.parquet(*[f"{kept.folder}/{n}" for n in Files(spark, kept.folder).names("")])
        assert lines.select("start").distinct().count() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    none = lambda rows: sorted(tuple(c or "" for c in r) for r in rows)
    assert none(map(tuple, got.collect())) == none(whole) and len(whole) == 3000


def test_files_are_united_by_name(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    for name, text in (("1.csv", "A;B\n1;x\n"), ("2.csv", "B;A\ny;2\n"), ("3.csv", 'A;C\n3;"p\nq"\n'), ("4+.csv", "A;B\n4;z\n")):
        write(folder / name, text)
    df = read_delimited(spark, str(folder))
    assert df.columns == ["A", "B", "C"]
    assert sorted(map(tuple, df.collect())) == [("1", "x", None), ("2", "y", None), ("3", None, "p\nq"), ("4", "z", None)]


@pytest.mark.parametrize("use", [lambda d: d.collect(), lambda d: d.select("a").collect(), lambda d: d.count()])
def test_too_many_cells_fail(spark, tmp_path, use):
    with pytest.raises(Exception, match="more than 3 cells"):
        use(read_delimited(spark, write(tmp_path / "b.csv", "a;b;c\n1;2;3\n2;;3;4\n")))


# -- staging --------------------------------------------------------------------


def test_first_column_wins_even_if_null(spark, rows):
    df = spark.createDataFrame([("x", None, "late", "u")], "a string, b string, c string, d string")
    got = select_renamed(df, {"c": "code", "b": "code", "a": "first", "gone": "absent"})
    assert got.columns == ["code", "first"] and rows(got) == [(None, "x")]


def test_typed_is_strict(spark):
    df = spark.createDataFrame([("12", "x")], "a string, b string")
    schema = schema_of("a int, c string")
    assert tuple(typed(df, schema).first()) == (12, None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed(df.select(F.col("b").alias("a")), schema).collect()


def test_load_date(spark):
    moment = datetime(2026, 9, 16, 4, 0)
    assert with_load_date(spark.range(1), moment).first().stg_load_date == moment


# -- store ----------------------------------------------------------------------

SCHEMA = schema_of("k int, n string")
PARTED = schema_of("k int, n string, p int")


def test_table_can_be_replaced_while_read(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    assert not store.exists("t") and store.read("t", SCHEMA).count() == 0
    assert store.replace("t", spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)) == 2
    assert store.replace("t", store.read("t", SCHEMA).where("k = 2")) == 1
    assert store.append("t", spark.createDataFrame([(3, "c")], SCHEMA)) == 1
    assert rows(store.read("t", SCHEMA)) == [(2, "b"), (3, "c")]


def test_empty_write(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(1, "a")], SCHEMA))
    empty = store.read("t", SCHEMA).where("k > 5")
    assert store.replace("t", empty, keep_if=lambda counts: not counts["rows"]) == 0 and store.read("t", SCHEMA).count() == 1
    assert store.replace("t", empty) == 0 and store.read("t", SCHEMA).count() == 0


def test_failed_write_leaves_the_old_rows(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(1, "a")], SCHEMA))
    with pytest.raises(Exception, match="stop here"):
        store.replace("t", spark.range(5).select(F.raise_error(F.lit("stop here")).cast("int").alias("k")))
    assert rows(store.read("t", SCHEMA)) == [(1, "a")]


def test_only_parts_with_a_change_are_written(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    data = [(1, "a", 1), (2, "b", 2), (3, "c", 2), (3, "c", 2), (4, "d", 3), (5, "e", None), (6, "f", 5)]
    store.replace("t", spark.createDataFrame(data, PARTED), "p")
    assert store.parts("t") == [1, 2, 3, 5]
    assert rows(store.read("t", PARTED, [2])) == [(2, "b", 2), (3, "c", 2), (3, "c", 2)]
    files = {n: store.files.names(f"t/{n}") for n in store.files.names("t")}
    old = store.rows("t", PARTED)
    # of two equal rows one changes; part 3 loses its only row; part 4 is new
    turn = F.row_number().over(Window.partitionBy("k").orderBy("_row"))
    action = F.when((F.col("k") == 3) & (turn == 1), "UPDATE").when(F.col("k").isin(2, 4), "DELETE").otherwise("NONE")
    changed = old.withColumn(ACTION, action).withColumn("n", F.when(F.col(ACTION) == "UPDATE", "new").otherwise(F.col("n")))
    new = spark.createDataFrame([(9, "z", 4, "INSERT"), (9, "z", 4, "INSERT")], "k int, n string, p int, _action string")
    done = store.apply("t", changed.unionByName(new, allowMissingColumns=True), PARTED, "p")
    assert done == {"inserted": 2, "updated": 1, "deleted": 2}
    assert rows(store.read("t", PARTED)) == sorted([(1, "a", 1), (3, "c", 2), (3, "new", 2), (5, "e", None), (6, "f", 5), (9, "z", 4), (9, "z", 4)], key=repr)
    after = {n: store.files.names(f"t/{n}") for n in store.files.names("t")}
    assert store.parts("t") == [1, 2, 4, 5]
    assert {n for n in files if after.get(n) != files[n]} == {"p=2", "p=3"}


def test_a_change_without_parts(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    none = store.rows("t", SCHEMA).withColumn(ACTION, F.lit("NONE"))
    new = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], SCHEMA).withColumn(ACTION, F.lit("INSERT"))
    assert store.apply("t", none.unionByName(new, allowMissingColumns=True), SCHEMA)["inserted"] == 3
    gone = store.rows("t", SCHEMA).where("k = 2").withColumn(ACTION, F.lit("DELETE"))
    assert store.apply("t", gone, SCHEMA) == {"inserted": 0, "updated": 0, "deleted": 1}
    assert rows(store.read("t", SCHEMA)) == [(1, "a"), (1, "a")]
    assert store.reload("t", spark.createDataFrame([(7, "x")], SCHEMA), SCHEMA) == {"inserted": 1, "updated": 0, "deleted": 2}
    assert rows(store.read("t", SCHEMA)) == [(7, "x")]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("at", range(1, 5))
def test_a_stopped_exchange_is_finished(spark, tmp_path, rows, monkeypatch, at):
    """The write is stopped before, between and after the parts; begun again it ends as if it had not been."""
    store = Store(spark, str(tmp_path), once=None)
    plain = Store(spark, str(tmp_path))
    data = [(i, "a", i % 3) for i in range(9)]
    plain.replace("t", spark.createDataFrame(data, PARTED), "p")
    kept = {}

    def stopping(prepare, publish):
        kept.update(plan=json.loads(json.dumps(prepare())), publish=publish)
        raise Stopped

    store.once = stopping
    old = store.rows("t", PARTED)
    changed = old.withColumn(ACTION, F.when(F.col("p") == 1, "DELETE").otherwise("UPDATE")).withColumn("n", F.lit("b"))
    with pytest.raises(Stopped):
        store.apply("t", changed, PARTED, "p")
    if at == 2:  # stopped when one part was in place
        schema = Store._with_action(PARTED)
        part = spark.read.schema(schema).parquet(f"{tmp_path}/{kept['plan']['changes']}")
        one = {**kept["plan"], "before": {"0": kept["plan"]["before"]["0"]}, "emptied": []}
        store._exchange("t", PARTED, "p", part, one)
    for _ in range(2 if at == 3 else 1):
        kept["publish"](kept["plan"])
    assert rows(plain.read("t", PARTED)) == sorted([(i, "b", i % 3) for i in range(9) if i % 3 != 1], key=repr)
    if at == 4:  # a part that Spark took away and did not put back is not passed over
        plain.files.remove("t/p=0")
        with pytest.raises(RuntimeError, match="missing"):
            kept["publish"](kept["plan"])


def test_a_draft_takes_the_place_once(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(1, "a")], SCHEMA))
    store.files.move("t", "_drafts/x")  # stopped between the two moves
    plan = {"draft": "_drafts/x"}
    for _ in range(2):
        store._swap("t", plan)
        assert rows(store.read("t", SCHEMA)) == [(1, "a")]


def test_a_failed_observation_is_raised(spark, tmp_path, monkeypatch):
    from py4j.protocol import Py4JJavaError
    from pyspark.sql import Observation

    class Lost(Py4JJavaError):
        def __init__(self):
            Exception.__init__(self, "lost")

        __str__ = Exception.__str__

    def lose(self):
        raise Lost

    monkeypatch.setattr(Observation, "get", property(lose))
    with pytest.raises(Lost):
        Store(spark, str(tmp_path)).replace("t", spark.createDataFrame([(1, "a")], SCHEMA))
    assert not Store(spark, str(tmp_path)).exists("t")


def test_a_merge_without_a_change_writes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.createDataFrame([(1, "a")], SCHEMA))
    before = store.files.names("t")
    store.apply("t", store.rows("t", SCHEMA).withColumn(ACTION, F.lit("NONE")), SCHEMA)
    assert store.files.names("t") == before


@pytest.mark.parametrize("partition", [None, "p"])
def test_scattered_appends_are_united(spark, tmp_path, rows, monkeypatch, partition):
    monkeypatch.setattr("dimkeep.sources.store.SCATTERED", 5)
    store = Store(spark, str(tmp_path))
    for i in range(12):
        store.append("t", spark.createDataFrame([(i, "a", i % 5 // 4)], PARTED).coalesce(1), partition)
    store.unite("t", PARTED, partition)
    assert rows(store.read("t", PARTED)) == sorted([(i, "a", i % 5 // 4) for i in range(12)], key=repr)
    files = len(store.files.names("t/p=0" if partition else "t"))
    assert files <= 2
    if partition:  # the other part was not scattered
        assert len(store.files.names("t/p=1")) == 2
    store.drop_drafts()
    assert store.tables() == ["t"]


def test_scratch_goes(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    with Scratch(spark, str(tmp_path)) as kept:
        assert kept.keep(spark.range(3)).count() == 3
        base, name = kept.folder.rsplit("/", 1)
        assert name in Files(spark, base).names("")
    assert name not in Files(spark, base).names("")
    assert spark.sparkContext.getCheckpointDir() == before


_RETRIED = """
import sys
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from dimkeep.plans.daily import DailyLoad
from dimkeep.plans.warehouse import Warehouse
from dimkeep.session import build_session
from datetime import date

spark = build_session("retry", "local[2,3]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3"})
spark.sparkContext.setLogLevel("OFF")

def fail_once(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
        raise ValueError("lost")  # after its rows have been handed on

wh = Warehouse(spark, sys.argv[1])
load = DailyLoad(wh, date(2026, 9, 16))
columns = "student_id int, event_type_code int, date_id int"
rows = spark.range(1000).select(F.col("id").cast("int").alias("student_id"), F.lit(1).alias("event_type_code"), F.lit(20260901).alias("date_id"))
watched, read = load._counted(rows.repartition(4))
kept = load.scratch.keep(watched.mapInArrow(fail_once, columns))
print(read(), kept.count(), wh.append("fact_student_event", rows.repartition(4).mapInArrow(fail_once, columns)), wh.table("fact_student_event").count())
load.scratch.clear()
"""


def test_counts_are_right_where_tasks_run_again(tmp_path):
    run = subprocess.run([sys.executable, "-c", _RETRIED, str(tmp_path)], cwd=REPO, capture_output=True, text=True, timeout=150)
    assert run.stdout.split() == ["1000"] * 4, run.stderr[-2000:]


def test_rows_meet_their_headers_without_a_shuffle(spark, tmp_path):
    """With the places of blocks and headers kept, each of both joins sends those and not the text."""
    keep = scratch(spark, tmp_path).keep
    lines = read_lines(spark, write(tmp_path / "h.csv", GOLDEN), scratch(spark, tmp_path))
    kept, plain = parse_sections(lines, ["Cprnr", "Feltnavn"], keep), parse_sections(lines, ["Cprnr", "Feltnavn"])
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, plain.collect()))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_many_columns_make_no_method_too_long_to_compile(spark, tmp_path, rows):
    """HotSpot leaves methods above 8,000 bytes to its interpreter; few and many columns read alike."""
    names = [f"c{i}" for i in range(40)]
    lines = [(0, "1;x"), (1, ";".join(["2", *names])), (2, ";".join(["4", *[str(i) if i % 3 else "" for i in range(40)], "more"])), (3, "4;short"),
             (4, "2;c3;c0"), (5, "5;three;zero;; "), (6, "5;three;;far")]
    df = spark.createDataFrame([("f", *x) for x in lines], "path string, ln long, line string")
    wanted = [*names, "absent", "_extra_2", "_extra_40"]
    many = parse_sections(df, wanted)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        # the places of cells are kept, so this is the code that each row runs through
        plan = parse_sections(df, wanted, Scratch(spark, str(tmp_path)).keep)._jdf.queryExecution()
        code = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
    for some in (["c0", "c3", "c4"], ["c39", "absent"], ["_extra_2", "_extra_40", "c1"]):
        assert rows(many, "row_type", *some) == rows(parse_sections(df, some), "row_type", *some)
    found = {(r.row_type, r.c0, r.c3, r.c4, r._extra_2, r._extra_40) for r in many.collect()}
    assert found == {("4", None, None, "4", None, "more"), ("4", "short", None, None, None, None), ("5", "zero", "three", None, None, None), ("5", None, "three", None, "far", None)}
