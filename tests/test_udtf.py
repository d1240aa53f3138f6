"""The audit table function from SQL equals the column-expression unpivot."""

from textmill.operators import audit


def test_table_function_equals_the_unpivot(spark):
    rows = [(1, "a,b,c", "1~2"), (2, "a", "x~y~z"), (3, None, "1"), (4, "a,b", None), (5, "", ""), (6, "a,,b", "~~")]
    df = spark.createDataFrame(rows, "id long, mask string, data string")
    df.createOrReplaceTempView("audit_fixture")
    name = audit.register_audit_pairs(spark)
    got = sorted(tuple(r) for r in spark.sql(f"SELECT f.id, p.* FROM audit_fixture f, LATERAL {name}(f.mask, f.data) p").collect())
    whole = df.where("mask IS NOT NULL AND data IS NOT NULL")
    want = sorted(tuple(r) for r in audit.unpivot_audit(whole, "id", "mask", "data").collect())
    assert got == want
    assert (2, "a", "x") in got and not [r for r in got if r[0] in (3, 4)]
