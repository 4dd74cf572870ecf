"""Loading in two batches at any watermark gives what one load gives."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from firstpour import BronzeConfig, LakeDatabase, Source, load, storage
from firstpour.operators.predicates import since
from firstpour.sources.workbook import _column_index, header_names, table_rows
from firstpour.testing import Shared, letters, workbook
from tests.conftest import DAY_1, DAY_2, rows

START = datetime(2024, 1, 1)
QUIET = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(max_examples=15, **QUIET)
@given(offsets=st.lists(st.integers(0, 20), max_size=30), cut=st.integers(0, 20))
def test_any_split_is_whole(spark, offsets, cut):
    data = [(i, START + timedelta(microseconds=o)) for i, o in enumerate(offsets)]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz")
    early = df.where(df.ts <= START + timedelta(microseconds=cut))
    high = early.selectExpr("CAST(max(ts) AS string)").first()[0]
    # The later rows arrive after the first load, all past its watermark.
    late = since(df, "ts", high)
    assert rows(early.unionAll(late)) == rows(df)


@settings(max_examples=4, **QUIET)
@given(offsets=st.lists(st.integers(0, 9), min_size=1, max_size=20), cut=st.integers(0, 9))
def test_two_loads_are_whole(spark, offsets, cut):
    root = storage.scratch(spark, "split")
    config = BronzeConfig("TEST", root, {"LAKE": LakeDatabase(f"{root}/source")}, root.rpartition("/")[2].replace("-", "_"))
    data = [(i, START + timedelta(microseconds=o)) for i, o in enumerate(offsets)]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz")
    source = Source("DB", "LAKE", "", "things", None, True, "ts")
    for arrived, day in ((df.where(df.ts <= START + timedelta(microseconds=cut)), DAY_1), (df, DAY_2)):
        arrived.write.mode("overwrite").parquet(f"{root}/source")
        table = load(spark, config, source, day).table
    assert rows(spark.table(table).select("id", "ts")) == rows(df)


@settings(max_examples=100, **QUIET)
@given(index=st.integers(0, 16383), row=st.integers(1, 1_048_576))
def test_cell_references(index, row):
    assert _column_index(f"{letters(index)}{row}") == index


@settings(max_examples=100, **QUIET)
@given(cells=st.lists(st.one_of(st.none(), st.sampled_from(["a", "A", "a.1", "Unnamed: 1", "b"])), max_size=8))
def test_header_names_are_distinct(cells):
    names = header_names(cells, 0)
    assert len({n.lower() for n in names}) == len(cells)
    assert all(name.lower().startswith(cell.lower()) for name, cell in zip(names, cells) if cell)


TEXT = st.text(st.characters(codec="utf-8", exclude_categories=("Cc", "Cs"), exclude_characters="￾￿"), min_size=1, max_size=8)


@settings(max_examples=50, **QUIET)
@given(table=st.lists(st.lists(st.one_of(st.none(), TEXT, TEXT.map(Shared)), min_size=1, max_size=5), min_size=1, max_size=8))
def test_workbook_text_round_trip(table):
    content = workbook({"S": {i: cells for i, cells in enumerate(table, 1)}})
    found = {number: cells for number, cells in table_rows(content, "S", 0)}
    for number, cells in enumerate(table, 1):
        while cells and cells[-1] is None:
            cells = cells[:-1]
        assert found.get(number, []) == cells
