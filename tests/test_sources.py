"""Loading, writing and describing tables."""

import pytest

from tradewind.session import shuffle_partitions, workspace
from tradewind.sources import tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"said ""wow""","two\nlines, one comma",2018-01-01 00:00:00,\n'
        "r2,o2,,,,not a date,\n"
    )
    loaded, missing = tables.load_tables(
        spark, {"order_reviews": str(tmp_path / "reviews.csv"), "sellers": str(tmp_path / "absent.csv")}
    )
    assert missing == ["sellers"] and list(loaded) == ["order_reviews"]
    first, second = loaded["order_reviews"].orderBy("review_id").collect()
    assert first["review_comment_title"] == 'said "wow"' and first["review_comment_message"] == "two\nlines, one comma"
    assert second["review_score"] is None and second["review_creation_date"] == "not a date"


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "payments.csv").write_text("payment_value,extra,order_id,payment_installments\n1.5,x,o1,3.0\nbad,,o2,2\n")
    loaded, _ = tables.load_tables(spark, {"order_payments": str(tmp_path / "payments.csv")})
    found = loaded["order_payments"].select("order_id", "payment_value", "payment_installments", "extra")
    assert rows(found) == [("o1", 1.5, 3, "x"), ("o2", None, 2, None)]


def test_row_order_remembers_the_file(spark, tmp_path):
    from tradewind.operators.clean import clean_customers

    lines = [f"c{i % 3},p{i},,city{i},SP" for i in range(9)]
    header = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    (tmp_path / "customers.csv").write_text(header + "\n".join(lines) + "\n")
    loaded, _ = tables.load_tables(spark, {"customers": str(tmp_path / "customers.csv")}, row_order=True)
    kept = clean_customers(loaded["customers"])
    assert rows(kept.select("customer_id", "customer_unique_id")) == [("c0", "p0"), ("c1", "p1"), ("c2", "p2")]


def test_round_trip_of_every_table(spark, small, tmp_path):
    from tradewind.plans.registry import retail

    r = retail(spark, small)
    for name, df in r.all().items():
        df.write.option("header", True).option("escape", '"').csv(str(tmp_path / name))
        loaded, _ = tables.load_tables(spark, {name: str(tmp_path / name)}, {name: df.schema})
        assert rows(loaded[name]) == rows(df), name


def test_write_replace_drops_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_replace(spark.range(10), path)
    tables.write_replace(spark.range(3).withColumnRenamed("id", "other"), path)
    assert rows(tables.scan_table(spark, path)) == [(0,), (1,), (2,)]


def test_profile_and_schema_info(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(tables.table_profile({"t": frame, "e": frame.limit(0)})) == [("e", 0, 2), ("t", 2, 2)]
    assert rows(tables.schema_info({"t": frame})) == [("t", "a", "int", 2), ("t", "b", "string", 1)]


def test_workspace_is_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second and first.startswith(base) and second.startswith(base)


@pytest.mark.parametrize("size, expected", [(0, 8), (1 << 28, 8), (100 << 40, 1_638_400), (1 << 40, 16_384)])
def test_shuffle_width_follows_the_input(size, expected):
    assert shuffle_partitions(size, cores=8) == expected


def test_marks_for_missing_cells_are_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNaN,NA\n1.5,null\n2,x\n")
    found = tables.load_csv(spark, str(tmp_path / "t.csv"), "a double, b string")
    assert rows(found) == sorted([(None, None), (1.5, None), (2.0, "x")], key=repr)
