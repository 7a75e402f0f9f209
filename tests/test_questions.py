"""Question rules against literal answers."""

import duckdb
import pytest

from tradewind.operators import answers
from tradewind.plans.checks import TAGGED
from tradewind.plans.registry import retail

QUESTIONS = [
    ("Orders in SP please", "state_orders_revenue", "SP"),
    ("revenue for rj and sp", "state_orders_revenue", "SP"),  # the code list decides, not the text
    ("how many orders", "state_orders_revenue", "RS"),  # any ending counts
    ("total sales", "state_orders_revenue", "ES"),
    ("I go to order", "state_orders_revenue", "GO"),
    ("who is the top seller?", "top_seller", None),
    ("how many sellers are there?", "seller_count", None),
    ("which state has the most orders?", "top_state", None),
    ("how much revenue did we make?", "total_revenue", None),
    ("what is the average order value?", "avg_item_value", None),
    ("what is the highest rating?", "rating_overview", None),
    ("number of orders?", "order_count", None),
    ("how many repeat customers?", "repeat_customer_share", None),
    ("how many customers?", "customer_count", None),
    ("average delivery time?", "avg_delivery_days", None),
    ("what is the cancellation rate?", "cancellation_share", None),
    ("which payment method?", "top_payment_type", None),
    ("best category?", "best_category", None),
    ("worst category?", "worst_category", None),
    ("how many category names?", "category_count", None),
    ("show the segments!", "segment_counts", None),
    ("how many products?", "product_count", None),
    ("tell me about the dataset", "dataset", None),
    ("  Hello \n", "greeting", None),
    ("weather?", "fallback", None),
    ("", "fallback", None),
    (None, "fallback", None),
]


@pytest.fixture(scope="module")
def tagged(spark):
    asked = spark.createDataFrame([(i, q[0]) for i, q in enumerate(QUESTIONS)], "n int, text string")
    return answers.tag_questions(asked)


def test_first_matching_rule_wins(tagged):
    found = [(r["text"], r["intent"], r["state"]) for r in tagged.orderBy("n").collect()]
    assert found == QUESTIONS


def test_the_checks_have_the_same_rules():
    """The SQL states the rules on its own; both reach every branch alike."""
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id INT, turn INT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, 1, 'user', ?)", [[n, q] for n, (q, *_) in enumerate(QUESTIONS)])
    found = con.execute(f"WITH {TAGGED} SELECT intent, state FROM tagged ORDER BY conv_id").fetchall()
    assert found == [(intent, state) for _, intent, state in QUESTIONS]
    assert len({intent for intent, _ in found}) == 21


def test_whole_word_state(spark):
    asked = spark.createDataFrame([("how many orders",), ("orders in SP",)], "text string")
    found = {r["text"]: (r["intent"], r["state"]) for r in answers.tag_questions(asked, whole_word=True).collect()}
    assert found == {
        "how many orders": ("order_count", None),
        "orders in SP": ("state_orders_revenue", "SP"),
    }


def test_questions_without_metric_keep_a_row(spark, tagged):
    metrics = spark.createDataFrame(
        [("state_orders_revenue", "SP", None, "orders", 3.0), ("order_count", None, None, "order_count", 9.0)],
        "intent string, state string, label string, metric string, value double",
    )
    answered = answers.answer_questions(tagged, metrics).collect()
    assert len(answered) == len(QUESTIONS)
    values = {r["text"]: r["value"] for r in answered}
    assert values["Orders in SP please"] == 3.0 and values["number of orders?"] == 9.0 and values["weather?"] is None
    assert values["how many orders"] is None  # tagged RS, which has no metric here


def test_state_questions_have_numbers(spark, small):
    r = retail(spark, small)
    metrics = answers.answer_metrics(r.all()).filter("intent = 'state_orders_revenue'").collect()
    found = {(m["state"], m["metric"]): m["value"] for m in metrics}
    assert found["SP", "orders"] == 0 and found["SP", "revenue"] == 0
    assert sum(v for (_, m), v in found.items() if m == "orders") > 0
    asked = spark.createDataFrame([("how much revenue in SP",)], "text string")
    (row,) = answers.answer_questions(answers.tag_questions(asked), answers.answer_metrics(r.all())).filter("metric = 'revenue'").collect()
    assert row["value"] == 0.0
