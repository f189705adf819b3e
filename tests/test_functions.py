import random

import pytest
from pyspark.sql import functions as F

from kinfold.functions import normalize as N
from kinfold.plans import catalogue
from tests.compare import assert_same

CASES = [
    (N.clean, "  a   b ", "a b"), (N.clean, "Not Disclosed", None), (N.clean, None, None),
    (N.display_name, "RAO, ishita", "Ishita Rao"), (N.display_name, "Ann McDonald", "Ann McDonald"), (N.display_name, "-", None),
    (N.email, " A.b+x@GoogleMail.com ", "a.b@gmail.com"), (N.email, "x@test.com", None), (N.email, "no address", None),
    (N.email_key, "a.b@gmail.com", "ab@gmail.com"), (N.email_key, "a.b@corp.org", "a.b@corp.org"), (N.email_type, "a@gmail.com", "personal"), (N.email_type, "a@corp.org", "work"),
    (N.phone, "098450 98450", "+919845098450"), (N.phone, "0044 7700 900123", "+447700900123"), (N.phone, "1111111111", None), (N.phone, "12", None),
    (N.profile_handle, "www.LinkedIn.com/in/Ann-1/?x=1", "ann-1"), (N.profile_handle, "https://linkedin.com/pub/a/b/c", "pub-a-b-c"), (N.profile_handle, "https://other.org/in/a", None), (N.profile_handle, "https://linkedin.com/in/", None),
    (N.experience_months, "6 Years 4 Months", 76), (N.experience_months, "4.5", 54), (N.experience_months, "soon", None), (N.experience_months, "0", 0),
    (N.salary_inr, "38 LPA", 3_800_000), (N.salary_inr, "120000 per month", 1_440_000), (N.salary_inr, "2600000", 2_600_000), (N.salary_inr, "n/a", None),
    (N.notice_days, "Immediate", 0), (N.notice_days, "2 weeks", 14), (N.notice_days, "3 months", 90), (N.notice_days, "60 days", 60),
    (N.company_key, "@Acme Software Pvt Ltd", "acme"), (N.company_key, "Foo Labs", "foo"),
]


@pytest.mark.parametrize("function", sorted({c[0] for c in CASES}, key=lambda f: f.__name__))
def test_scalar(function, spark):
    mine = [(i, c[1], c[2]) for i, c in enumerate(CASES) if c[0] is function]
    df = spark.createDataFrame([x[:2] for x in mine], "i int, x string").select("i", function(F.col("x")).alias("y"))
    assert {r.i: r.y for r in df.collect()} == {i: y for i, _, y in mine}


def test_location_and_skills(spark):
    df = spark.createDataFrame([("Bangalore / Remote",), ("Pune, MH, India",), ("Remote",), (None,)], "x string").select(N.location(F.col("x")).alias("p"))
    got = [(r.p.city, r.p.state, r.p.country) for r in df.collect()]
    assert got == [("bengaluru", "karnataka", "IN"), ("pune", "maharashtra", "IN"), (None, None, None), (None, None, None)]
    one = spark.createDataFrame([(["K8s", " python", "kubernetes", "n/a"],), (None,)], "x array<string>").select(N.skills(F.col("x")).alias("s"))
    assert [r.s for r in one.collect()] == [["kubernetes", "python"], []]


def test_content_hash_ignores_key_order(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"b":2,"a":1}',), ("{bad",)], "x string").select(N.content_hash(F.col("x")).alias("h"))
    a, b, c = [r.h for r in df.collect()]
    assert a == b != c


def test_fixed_rounds_the_exact_value(spark):
    """As C and Python print a double; the shortest decimals of many of these are ties, which Java's formatter rounds up."""
    r = random.Random(0)
    values = [k / 10000 for k in range(-2005, 10000, 10)] + [k / 8 for k in range(-40, 40)] + [r.uniform(-1, 1) * 10.0 ** r.randrange(-8, 19) for _ in range(500)]
    values += [0.2415, 0.9995, 0.9994999999999999, 0.99951, 999.9995, -0.0, -1e-9, 5e-324, 2.0**52 + 0.5, 2.0**61, 4503599627370.4971]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(-1, None)], "i int, x double")
    for places in (2, 3):
        got = {x.i: x.y for x in df.select("i", N.fixed(F.col("x"), places).alias("y")).collect()}
        assert got == {i: f"{v:.{places}f}" for i, v in enumerate(values)} | {-1: None}


def test_export_rows_prints_balances_exactly(spark, duck, tmp_path):
    """Balances in ties of the third decimal, and one that is missing."""
    customers = [(i, f"c{i}", 0, (i * 10 + 5) / 1.0, "x") for i in range(900)] + [(900, "c", 0, None, "x")]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(1, 1, "F", 1.0, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    other = duck.cursor()
    for name in ("customer", "orders"):
        other.execute(f"CREATE TEMP VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert_same(catalogue.queries()["q42_export_rows"](spark, str(tmp_path)), other, catalogue.oracle_sql()["q42_export_rows"])
