import pytest
from compare import assert_same, connect
from sievestone.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, small, duck, name):
    made = QUERIES[name](spark, small).toPandas()
    if name in ORACLES:
        assert_same(made, duck.sql(ORACLES[name]).df())


def test_inventory_equals_a_listing(spark, small):
    import os

    made = {(r["stem"] + r["suffix"], r["length"]) for r in QUERIES["file_inventory"](spark, small).collect()}
    assert made == {(f, os.path.getsize(f"{small}/{f}")) for f in os.listdir(small)}


def test_no_pair_crosses_a_split_by_rules(spark):
    made = QUERIES["rule_leakage"](spark, "/root/testdata/sf0.01").collect()
    assert {r["split"] for r in made} == {"official_all", "official_kept", "new"}
    assert not any(r["crossing"] for r in made if r["split"] == "new") and any(r["crossing"] for r in made if r["split"] == "official_all")


def test_no_pair_crosses_the_new_split(spark):
    made = QUERIES["resplit_crossings"](spark, "/root/testdata/sf0.01").collect()
    assert made and not any(r["crossing"] for r in made)


def repeated(small, folder, **changed):
    """The tables of a folder, some of them put in anew by DuckDB SQL."""
    import os

    import duckdb

    for name in os.listdir(small):
        if name.removesuffix(".parquet") not in changed:
            os.symlink(f"{small}/{name}", folder / name)
    for name, sql in changed.items():
        duckdb.connect().sql(f"COPY ({sql.format(old=f"'{small}/{name}.parquet'")}) TO '{folder}/{name}.parquet'")
    return str(folder)


def test_equal_signs_are_no_exact_copies(spark, small, tmp_path):
    """Vectors of equal signs and other lengths: near copies at distance 0, as in the SQL."""
    d = repeated(small, tmp_path, embeddings="SELECT * FROM {old} UNION ALL SELECT vec_id + 500 + vec_id % 7, list_transform(embedding, lambda x: 2 * x), label FROM {old} WHERE vec_id < 40")
    made = QUERIES["preparation_manifest"](spark, d).toPandas()
    assert_same(made, connect(d).sql(ORACLES["preparation_manifest"]).df())


@pytest.mark.parametrize("name", ["final_validation", "qa_report"])
def test_checks_take_lines_apart_once(spark, small, name):
    """Several counts read the checked lines; they read a kept table, not the pattern again."""
    plan = QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "lpad" not in plan  # of the text of a line
