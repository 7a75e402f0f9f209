"""Answers to common questions, and the rules that tell which question was asked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.rounding import percent
from tradewind.operators.insights import orders_per_person
from tradewind.operators.kpis import avg_delivery_days, order_sums, segment_counts

MIN_CATEGORY_REVIEWS = 50

# State codes in the order they are looked for.
STATE_CODES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "DF", "ES", "GO", "PE", "CE", "PA", "MT",
    "MA", "MS", "PB", "PI", "RN", "AL", "SE", "TO", "RO", "AM", "AC", "AP", "RR",
]

# Keyword rules in order, the first match wins.  A rule is a list of
# alternatives, an alternative a list of word groups; each group needs one of its words.
COUNTING = ["how many", "total", "number of"]
INTENT_RULES: list[tuple[str, list[list[list[str]]]]] = [
    ("top_seller", [[["top"], ["seller"]]]),
    ("seller_count", [[["seller"], COUNTING]]),
    ("top_state", [[["state"], ["most", "top", "highest"]]]),
    ("total_revenue", [[["total revenue", "how much revenue"]], [["revenue"], ["total"]]]),
    ("avg_item_value", [[["average order", "avg order value"]]]),
    ("rating_overview", [[["rating", "review"]]]),
    ("order_count", [[["order"], ["how many"]], [["total orders", "number of orders"]]]),
    ("repeat_customer_share", [[["repeat"], ["customer"]]]),
    ("customer_count", [[["customer"], COUNTING]]),
    ("avg_delivery_days", [[["delivery", "delay", "shipping time"]]]),
    ("cancellation_share", [[["cancel"]]]),
    ("top_payment_type", [[["payment"]]]),
    ("best_category", [[["category"], ["best", "top", "highest rated"]]]),
    ("worst_category", [[["category"], ["worst", "lowest"]]]),
    ("category_count", [[["category"], ["how many", "number of"]]]),
    ("segment_counts", [[["high value", "segment", "rfm"]]]),
    ("product_count", [[["product"], COUNTING]]),
    ("dataset", [[["csv", "dataset", "how many files", "about this project", "about the project"]]]),
]
# Words that make a question with a state code one about that state, and greetings.
STATE_WORDS = ["order", "revenue", "sales"]
GREETINGS = ["hi", "hello", "hey", "hi there", "hello there"]


def state_orders_revenue(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Per state: item lines (an order without items counts once) and revenue."""
    return (
        orders.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(order_sums(items).select("order_id", "lines", "price"), "order_id", "left")
        .groupBy("customer_state")
        .agg(
            F.sum(F.when(F.col("order_id").isNotNull(), F.coalesce("lines", F.lit(1)))).alias("orders"),
            F.round(F.coalesce(F.sum("price"), F.lit(0.0)), 2).alias("revenue"),
        )
    )


def orders_revenue_of_state(orders: DataFrame, customers: DataFrame, items: DataFrame, state: str) -> DataFrame:
    """The same for one state."""
    return state_orders_revenue(orders, customers.filter(F.col("customer_state") == state), items)


def top_seller(items: DataFrame) -> DataFrame:
    """The seller with the highest Σ price, and its item lines."""
    return (
        items.groupBy("seller_id")
        .agg(F.sum("price").alias("sum_price"), F.count("*").alias("item_lines"))
        .orderBy(F.col("sum_price").desc_nulls_first(), "seller_id")
        .limit(1)
        .select("seller_id", F.round("sum_price", 2).alias("revenue"), "item_lines")
    )


def seller_count(sellers: DataFrame) -> DataFrame:
    return sellers.agg(F.count("*").alias("seller_count"))


def top_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The state with most orders."""
    return (
        orders.select("customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.col("orders").desc(), F.col("customer_state").asc_nulls_last())
        .limit(1)
    )


def total_revenue(items: DataFrame) -> DataFrame:
    return items.agg(F.round(F.sum("price"), 2).alias("total_revenue"))


def avg_item_value(items: DataFrame) -> DataFrame:
    """Average price per item line (asked for as "average order value")."""
    return items.agg(F.round(F.avg("price"), 4).alias("avg_item_value"))


def rating_overview(reviews: DataFrame) -> DataFrame:
    """Average score, the highest score with its count, and the most frequent score.

    The answer text calls the highest score "most common"; both are given.
    """
    counted = reviews.groupBy("review_score").agg(F.count("*").alias("n"))
    scored = F.col("review_score").isNotNull()
    most = F.max(F.when(scored, F.struct("n", (-F.col("review_score")).alias("negated"))))
    highest = F.max(F.when(scored, F.struct("review_score", "n")))
    weighted = F.sum(F.col("review_score") * F.col("n"))
    return counted.agg(
        F.round(weighted / F.nullif(F.sum(F.when(scored, F.col("n"))), F.lit(0)), 6).alias("avg_score"),
        highest.alias("highest"),
        most.alias("most"),
    ).select(
        "avg_score",
        F.col("highest.review_score").alias("highest_score"),
        F.col("highest.n").alias("highest_score_reviews"),
        (-F.col("most.negated")).alias("most_common_score"),
        F.col("most.n").alias("most_common_reviews"),
    )


def order_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("*").alias("order_count"))


def repeat_customer_share(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Persons with one order, with more, all of them, and the repeat share in percent."""
    n = F.col("order_count")
    return orders_per_person(orders, customers).agg(
        F.count_if(n == 1).alias("one_time"),
        F.count_if(n > 1).alias("repeat_buyers"),
        F.count("*").alias("total_persons"),
        percent(F.count_if(n > 1), F.count("*")).alias("repeat_pct"),
    )


def customer_count(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count_distinct("customer_id").alias("customer_count"))


def cancellation_share(orders: DataFrame) -> DataFrame:
    """Canceled orders, all orders, and the share in percent."""
    canceled = F.count_if(F.col("order_status") == "canceled")
    return orders.agg(
        canceled.alias("cancelled"), F.count("*").alias("total_orders"), percent(canceled, F.count("*")).alias("cancel_pct")
    )


def top_payment_type(payments: DataFrame) -> DataFrame:
    """The most used payment type and its share of all payments."""
    counted = payments.groupBy("payment_type").agg(F.count("*").alias("transactions"))
    most = F.min(F.struct((-F.col("transactions")).alias("negated"), F.col("payment_type").isNull(), "payment_type"))
    return counted.agg(most.alias("most"), F.sum("transactions").alias("all")).select(
        F.col("most.payment_type").alias("payment_type"),
        (-F.col("most.negated")).alias("transactions"),
        percent(-F.col("most.negated"), F.col("all")).alias("share_pct"),
    )


def _category_scores(reviews: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Σ and count of scores over review x item rows per native category.

    Reviews are summed per order first, and lines per product before the product join.
    """
    per_order = reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"), F.sum("review_score").alias("score"), F.count("review_score").alias("scored")
    )
    per_product = (
        items.select("order_id", "product_id")
        .join(per_order, "order_id")
        .groupBy("product_id")
        .agg(F.sum("reviews").alias("reviews"), F.sum("score").alias("score"), F.sum("scored").alias("scored"))
    )
    return (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("reviews").alias("reviews"), F.sum("score").alias("score"), F.sum("scored").alias("scored"))
        .filter(F.col("reviews") >= MIN_CATEGORY_REVIEWS)
        .withColumn("avg", F.col("score") / F.nullif(F.col("scored"), F.lit(0)))
    )


def _first_category(scores: DataFrame, order: Column) -> DataFrame:
    first = scores.orderBy(order, F.col("product_category_name").asc_nulls_last()).limit(1)
    return first.select("product_category_name", F.round("avg", 6).alias("avg_score"), "reviews")


def best_category(reviews: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The category with the best average score among those with enough reviews."""
    return _first_category(_category_scores(reviews, items, products), F.col("avg").desc_nulls_first())


def worst_category(reviews: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """The category with the worst average score among those with enough reviews."""
    return _first_category(_category_scores(reviews, items, products), F.col("avg").asc_nulls_last())


def category_count(products: DataFrame) -> DataFrame:
    return products.agg(F.count_distinct("product_category_name").alias("category_count"))


def product_count(products: DataFrame) -> DataFrame:
    return products.agg(F.count("*").alias("product_count"))


def _contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def _matches(text: Column, rule: list[list[list[str]]]) -> Column:
    alternatives = [reduce(lambda a, b: a & b, [_contains_any(text, g) for g in groups]) for groups in rule]
    return reduce(lambda a, b: a | b, alternatives)


def mentioned_state(padded: Column, whole_word: bool = False) -> Column:
    """The first state code that stands between blanks or ends the text.

    Takes the upper-cased text with a blank on both sides.  Any ending counts, also
    that of a longer word ("orders" ends in RS); with ``whole_word`` it does not.
    """

    def found(code: str) -> Column:
        between = padded.contains(f" {code} ")
        return between if whole_word else between | padded.endswith(f"{code} ")

    return F.coalesce(*[F.when(found(code), F.lit(code)) for code in STATE_CODES])


def tag_questions(questions: DataFrame, text: str = "text", whole_word: bool = False) -> DataFrame:
    """Adds ``intent`` and, for questions about one state, ``state`` to every question.

    Texts are prepared in columns of their own, so each is computed once per row.
    """
    lowered, padded, code = F.col("_lowered"), F.col("_padded"), F.col("_code")
    about_state = code.isNotNull() & _contains_any(lowered, STATE_WORDS)
    intent = F.when(about_state, "state_orders_revenue")
    for name, rule in INTENT_RULES:
        intent = intent.when(_matches(lowered, rule), name)
    # blanks here include line breaks and tabs
    stripped = F.regexp_replace(lowered, r"^\s+|\s+$", "")
    intent = intent.when(stripped.isin(GREETINGS), "greeting").otherwise("fallback")
    return (
        questions.withColumn("_lowered", F.lower(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("_padded", F.concat(F.lit(" "), F.upper(lowered), F.lit(" ")))
        .withColumn("_code", mentioned_state(padded, whole_word))
        .withColumns({"intent": intent, "state": F.when(about_state, code)})
        .drop("_lowered", "_padded", "_code")
    )


def question_counts(tagged: DataFrame) -> DataFrame:
    """Questions per intent and state."""
    return tagged.groupBy("intent", "state").agg(F.count("*").alias("questions"))


def answer_metrics(tables: dict[str, DataFrame], segments: DataFrame | None = None) -> DataFrame:
    """Every answer as rows (intent, state, metric, label, value).

    Every state of the customers has rows, and so has every state code that can be asked for:
    zero orders and revenue where there are none.  Segment answers need the segment table.
    """
    orders, customers, items = tables["orders"], tables["customers"], tables["order_items"]
    reviews, products, payments = tables["order_reviews"], tables["products"], tables["order_payments"]

    def rows(intent: str, df: DataFrame, label: str | None = None, state: Column | None = None) -> DataFrame:
        metrics = [c for c in df.columns if c not in (label, "customer_state")]
        cells = F.array(
            *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
        )
        return df.select(
            F.lit(intent).alias("intent"),
            (F.lit(None) if state is None else state).cast("string").alias("state"),
            (F.lit(None) if label is None else F.col(label)).cast("string").alias("label"),
            F.inline(cells),
        )

    known_state = F.col("customer_state")
    states = state_orders_revenue(orders, customers.filter(known_state.isNotNull()), items)
    codes = orders.sparkSession.createDataFrame([(c, 0, 0.0) for c in STATE_CODES], states.schema)
    states = states.unionByName(codes).groupBy("customer_state").agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    most_orders = top_state(orders, customers).withColumnRenamed("customer_state", "leading_state")
    parts = [
        rows("state_orders_revenue", states, state=known_state),
        rows("top_seller", top_seller(items), "seller_id"),
        rows("seller_count", seller_count(tables["sellers"])),
        rows("top_state", most_orders, "leading_state"),
        rows("total_revenue", total_revenue(items)),
        rows("avg_item_value", avg_item_value(items)),
        rows("rating_overview", rating_overview(reviews)),
        rows("order_count", order_count(orders)),
        rows("repeat_customer_share", repeat_customer_share(orders, customers)),
        rows("customer_count", customer_count(customers)),
        rows("avg_delivery_days", avg_delivery_days(orders)),
        rows("cancellation_share", cancellation_share(orders)),
        rows("top_payment_type", top_payment_type(payments), "payment_type"),
        rows("best_category", best_category(reviews, items, products), "product_category_name"),
        rows("worst_category", worst_category(reviews, items, products), "product_category_name"),
        rows("category_count", category_count(products)),
        rows("product_count", product_count(products)),
    ]
    if segments is not None:
        parts.append(rows("segment_counts", segment_counts(segments), "segment"))
    return reduce(DataFrame.unionByName, parts)


def answer_questions(tagged: DataFrame, metrics: DataFrame) -> DataFrame:
    """Each tagged question with its metric rows; questions without any keep one row."""
    same = tagged["intent"].eqNullSafe(metrics["intent"]) & tagged["state"].eqNullSafe(metrics["state"])
    return tagged.join(metrics, same, "left").select(
        *[tagged[c] for c in tagged.columns], metrics["metric"], metrics["label"], metrics["value"]
    )
