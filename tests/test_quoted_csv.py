"""CSV with line breaks in quotes: many tasks per file, rows equal to the one-task reader."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.sources import quoted_csv
from tradewind.sources.tables import load_csv


def quoted(cell):
    return '"' + cell.replace('"', '""') + '"'


@pytest.fixture(scope="module", params=["\n", "\r\n"])
def folder(request, tmp_path_factory):
    """Two files of a few hundred KB with breaks, commas, quotes and empty lines in cells, one record far longer than a block."""
    path, rng = tmp_path_factory.mktemp("csv"), random.Random(3)
    pieces = ["plain", "é ü", 'say "x"', "a,b", "line\nbreak", "\n\n", '"', "", "2017-01-01", '""', "tail\n"]
    for name, rows in (("a.csv", 4000), ("b.csv", 900)):
        out = ["review_id,order_id,message,score"]
        for k in range(rows):
            message = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))
            if k == 700:
                message = "\n".join("long, \"text\"" for _ in range(9000))
            cell = quoted(message) if rng.random() < 0.9 or any(c in message for c in ',"\n') else message
            out.append(f"r{k},{k % 97},{cell},{k % 5 + 1}")
            if k % 300 == 7:
                out.append("")
        (path / name).write_bytes((request.param.join(out) + request.param * (name == "a.csv")).encode())
    return str(path)


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "8192")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_rows_equal_the_multiline_reader(spark, folder, small_blocks):
    plain = spark.read.option("header", True).options(**quoted_csv.OPTIONS).csv(folder)
    expected = Counter(map(tuple, plain.collect()))
    found = quoted_csv.read_quoted_csv(spark, folder)
    assert quoted_csv.numbered_lines(spark, folder).rdd.getNumPartitions() > 40 and plain.rdd.getNumPartitions() <= 2
    assert Counter(tuple(r)[:-1] for r in found.collect()) == expected and sum(expected.values()) == 4900


def test_places_follow_the_order_of_the_files(spark, folder, small_blocks):
    found = quoted_csv.read_quoted_csv(spark, folder).filter(F.col("_place.file").endswith("a.csv")).orderBy("_place")
    assert [r.review_id for r in found.collect()] == [f"r{k}" for k in range(4000)]


def test_one_block_gives_the_same_rows(spark, folder):
    plain = spark.read.option("header", True).options(**quoted_csv.OPTIONS).csv(folder)
    assert Counter(tuple(r)[:-1] for r in quoted_csv.read_quoted_csv(spark, folder).collect()) == Counter(map(tuple, plain.collect()))


def test_typed_and_in_order(spark, folder, small_blocks):
    schema = "review_id string, order_id bigint, message string, score bigint"
    found = load_csv(spark, folder, schema, row_order=True, multi_line=True)
    assert dict(found.dtypes)["order_id"] == "bigint" and found.columns[-1] == "_row_order"
    assert found.agg(F.sum("score")).first()[0] == sum(k % 5 + 1 for k in [*range(4000), *range(900)])


def test_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n')
    (tmp_path / "b.csv").write_text("x,z\n2,c\n")
    with pytest.raises(Exception, match="other header"):
        quoted_csv.read_quoted_csv(spark, str(tmp_path)).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n")
    assert quoted_csv.read_quoted_csv(spark, str(tmp_path)).drop("_place").collect() == []
