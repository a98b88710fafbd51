import pytest

from tillwise.operators import policy, sets


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "Alice", 100)], "id int, name string, amount int")
    b = spark.createDataFrame([(200, 2, "Bob")], "amount int, id int, name string")
    assert rows(sets.union_by_name(a, b), "id", "name", "amount") == [(1, "Alice", 100), (2, "Bob", 200)]
    c = spark.createDataFrame([(2, "Bob", "Engineering")], "id int, name string, department string")
    assert rows(sets.union_by_name(a, c), "id", "name", "amount", "department") == [
        (1, "Alice", 100, None), (2, "Bob", None, "Engineering")]


def test_except_and_intersect_by_name(spark, rows):
    a = spark.createDataFrame([(1, "Alice"), (1, "Alice"), (2, None)], "id int, name string")
    b = spark.createDataFrame([("Alice", 1)], "name string, id int")
    assert rows(sets.except_by_name(a, b)) == [(2, None)]
    assert rows(sets.intersect_by_name(a, b)) == [(1, "Alice")]
    with pytest.raises(ValueError):
        sets.except_by_name(a, b.drop("id"))


def test_chain_sees_all_earlier_results(spark):
    out = sets.chain(spark.range(5), lambda r: r[0].filter("id > 1"), lambda r: r[0].unionByName(r[1]))
    assert out.count() == 8


def test_policy_by_role(spark):
    df = spark.createDataFrame([("CA",), ("OR",), ("CO",), (None,)], "state string")

    def seen(*roles):
        return policy.apply_row_policy(df, roles).count()

    assert seen("ADMIN") == 4
    assert seen("WEST_COAST_MANAGER") == 2
    assert seen("INTERN") == 0
    assert seen() == 0
    assert seen("INTERN", "WEST_COAST_MANAGER") == 2


def test_guarded_tables_cannot_be_bypassed(tables):
    guarded = policy.GuardedTables({"customers": tables.customers, "orders": tables.orders}, ["WEST_COAST_MANAGER"],
                                   {"customers": policy.CUSTOMER_REGION})
    guarded.register_views()
    states = {r[0] for r in tables.spark.sql("SELECT DISTINCT state FROM customers").collect()}
    assert states <= {"CA", "OR", "WA"} and states
    assert guarded["orders"].count() == tables.orders.count()
