"""Queries beside their SQL on tables that the given ones don't show: fractions, missing flags, keys below zero, repeated rows."""
import duckdb
import pytest

from allelespark.operators.display import manhattan_input
from allelespark.plans import catalog

#: 3 suppliers and 6 parts, a line for every sample of each part; halves and quarters in l_quantity, in numbers that round up or down
LINES = """
    SELECT o AS l_orderkey, p AS l_partkey, p % 3 AS l_suppkey, 1::INTEGER AS l_linenumber, 205.0 + (o * 7 + p * 3) % 41 + (o % 4) * 0.25 AS l_quantity,
           1000.0::DOUBLE + (o * 37 + p * 11) % 89 AS l_extendedprice, (o % 11) / 100.0::DOUBLE AS l_discount, (o % 9) / 100.0::DOUBLE AS l_tax,
           ['A', 'N', 'R'][1 + o % 3] AS l_returnflag
    FROM range(40) a(o), range(6) b(p)"""


def beside_sql(spark, folder, name, lines=LINES, times=1):
    """Sorted rows of a registered query and of its SQL; ``times`` repeats the rows of part and supplier."""
    con = duckdb.connect()
    tables = {
        "lineitem": f"SELECT * REPLACE (l_quantity::DOUBLE AS l_quantity) FROM ({lines})",
        "orders": "SELECT o AS o_orderkey, o * 3 AS o_custkey, 100.0::DOUBLE + o AS o_totalprice FROM range(40) r(o)",
        "part": f"SELECT p AS p_partkey, 5::INTEGER AS p_size FROM range(6) r(p), range({times}) t(i)",
        "supplier": f"SELECT s AS s_suppkey FROM range(3) r(s), range({times}) t(i)",
    }
    for t, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    return sorted(str(tuple(r)) for r in df.collect()), sorted(map(str, want))


@pytest.mark.parametrize("name", ["k3_phenotype_bed", "s3_wide_matrix"])
def test_fractions_in_written_counts(spark, tmp_path, name):
    got, want = beside_sql(spark, tmp_path, name)
    assert got == want and len(want) >= 4


@pytest.mark.parametrize("flag,first", [("CASE WHEN o % 3 = 1 THEN NULL ELSE 'A' END", 0), ("'A'", -2000)])
def test_manhattan_rows_without_a_log(spark, tmp_path, flag, first):
    """A missing flag gives no p, and keys below zero give a p below zero."""
    lines = LINES.replace("['A', 'N', 'R'][1 + o % 3]", flag).replace("p AS l_partkey", f"p + {first} AS l_partkey")
    got, want = beside_sql(spark, tmp_path, "p8_manhattan_input", lines)
    assert got == want and any("None" in r or "nan" in r for r in want)


def test_manhattan_input_drops_what_has_no_log(spark):
    df = spark.createDataFrame([("1", 5, 0.1), ("1", 6, None), ("1", 7, -0.1), (None, 8, 0.1)], "chromosome string, position long, p_value double")
    assert [r["position"] for r in manhattan_input(df).collect()] == [5]
    assert [r["position"] for r in manhattan_input(df, scored=False).sort("position").collect()] == [5, 6, 7]


@pytest.mark.parametrize("name,times", [("q1_cis_nominal", 1), ("q1_cis_nominal", 3), ("q2_best_variant", 3)])
def test_scans_of_fractions_and_repeated_places(spark, tmp_path, name, times):
    """Quantities with fractions are rounded to dosages; a part or supplier that is listed again adds no pair."""
    got, want = beside_sql(spark, tmp_path, name, times=times)
    assert got == want and len(want) == 3


def test_repeated_places_without_fractions(spark, tmp_path):
    got, want = beside_sql(spark, tmp_path, "q1_cis_nominal", LINES.replace("0.25", "1"), times=2)
    assert got == want and len(want) == 3


#: 119 parts with carriers only among the samples that a trait lacks (sample % 3 = 0), and one that varies in all
CARRIERS = """
    SELECT o AS l_orderkey, p AS l_partkey, p % 3 AS l_suppkey, 1::INTEGER AS l_linenumber, 1000.0::DOUBLE + (o * 37 + p * 11) % 89 AS l_extendedprice,
           3.0 + CASE WHEN p = 0 THEN (o * o + o // 7) % 3 WHEN o % 3 = 0 THEN (o // 3 * 7 + p * o // 3 + p // 14) % 3 ELSE 0 END AS l_quantity,
           0.0::DOUBLE AS l_discount, 0.0::DOUBLE AS l_tax, 'A' AS l_returnflag
    FROM range(40) a(o), range(120) b(p)"""


@pytest.mark.parametrize("name", ["q5_linear_gwas_gaps", "q5_linear_gwas_p_values"])
def test_variants_without_carriers_where_the_trait_is_measured(spark, tmp_path, name):
    """What is left of a variant there is rounding, not variation."""
    got, want = beside_sql(spark, tmp_path, name, CARRIERS)
    assert got == want and len(want) == 1
