"""Staging that is replaced and removed, catalog tables with defaults, seeds, and an entry that survives missing libraries."""

import builtins
import importlib
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import digest, duck  # noqa: E402
from daybook.schemas import TERMINAL_ATTRS, TERMINAL_KEYS, TERMINALS, history_schema  # noqa: E402
from daybook.sources.staging import Staging  # noqa: E402
from daybook.sources.tables import HISTORY_DEFAULTS, create_table, insert_partial  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["feed_routing_drop", "staging_replace", "seed_dimensions", "insert_with_defaults", "surrogate_ids_stable"])
def test_query_matches_duckdb(spark, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(E.oracle_sql()[name])
    names, expected = [c[0] for c in cur.description], cur.fetchall()
    assert rows and sorted(df.columns) == sorted(names) and digest(df.columns, rows) == digest(names, expected)


def test_staging_is_replaced_and_leaves_nothing(spark, tmp_path):
    with Staging(spark, str(tmp_path)) as stage:
        first = stage.replace("a", spark.range(3))
        assert stage.replace("a", spark.range(5)).count() == 5 and first.count() == 3  # a plan made before reads on
        assert stage.replace("a", spark.range(0)).count() == 0
        with pytest.raises(Exception, match="lost"):
            stage.replace("a", spark.range(9).selectExpr("IF(id = 8, CAST(raise_error('lost') AS BIGINT), id) AS id"))
        assert stage.read("a").count() == 0  # a failed write leaves what was staged
    assert os.listdir(tmp_path) == [] and not spark.catalog.tableExists("stg_a")


def test_staging_is_removed_after_an_error(spark, tmp_path):
    with pytest.raises(ValueError), Staging(spark, str(tmp_path)) as stage:
        stage.replace("b", spark.range(3))
        raise ValueError
    assert os.listdir(tmp_path) == [] and not spark.catalog.tableExists("stg_b")


def test_tables_take_defaults_and_refuse_others(spark, tmp_path):
    name, schema = f"t_{uuid.uuid4().hex}", history_schema(TERMINAL_KEYS, TERMINAL_ATTRS, TERMINALS)
    create_table(spark, name, schema, str(tmp_path / "t"), HISTORY_DEFAULTS)
    create_table(spark, name, schema, str(tmp_path / "t"), HISTORY_DEFAULTS)
    insert_partial(spark.sql("SELECT 'x' AS terminal_id"), name)
    insert_partial(spark.sql("SELECT 1 AS deleted_flg, CAST(NULL AS STRING) AS terminal_id"), name)
    got = {r.terminal_id: (str(r.effective_to), r.deleted_flg, r.effective_from, r.id) for r in spark.table(name).collect()}
    assert got == {"x": ("2999-12-31 00:00:00", 0, None, None), None: ("2999-12-31 00:00:00", 1, None, None)}
    with pytest.raises(ValueError, match="other columns or defaults"):
        create_table(spark, name, schema, str(tmp_path / "t"), {"deleted_flg": "1"})
    with pytest.raises(ValueError, match="unknown columns"):
        create_table(spark, name, schema, str(tmp_path / "t"), {"other": "1"})
    with pytest.raises(Exception, match="nowhere"):
        insert_partial(spark.sql("SELECT 1 AS nowhere"), name)
    spark.sql(f"DROP TABLE {name}")


def test_entry_survives_a_missing_library(monkeypatch):
    """Without a library of the corpus modules the relational queries are still there, and it is said what is missing."""
    real = builtins.__import__

    def without(name, *rest, **named):
        if name.split(".")[0] in ("zstandard", "public_tokenizers"):
            raise ModuleNotFoundError(f"No module named {name!r}")
        return real(name, *rest, **named)

    for module in [m for m in sys.modules if m.startswith("daybook.llm") or m in ("corpus_pipeline", "zstandard", "public_tokenizers")]:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    with pytest.warns(UserWarning, match="is left out"):
        assert set(entry.queries()) == set(entry.catalog.queries())
    with pytest.warns(UserWarning):
        assert set(entry.oracle_sql()) == set(entry.catalog.queries())
