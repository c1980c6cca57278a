"""The reference's data model derived from the driver's Parquet tables.

The reference ships no input data, so each of its inputs is derived from the
driver tables (see FIXTURES.md).  Every frame here is a lazy projection/join
of whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.clean import epoch_to_timestamp
from revlens.session import apply_runtime_conf
from revlens.sources.readers import read_table


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    apply_runtime_conf(spark)
    return read_table(spark, d, name)


def rating_from_priority(c: str = "o_orderpriority") -> F.Column:
    """rating = 6 - first digit of the order priority (1-URGENT -> 5)."""
    return (F.lit(6) - F.substring(F.col(c), 1, 1).cast("int")).cast("double")


def reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews for RFM and trends: one per order.

    comment_id = o_orderkey, customer_id = o_custkey, customer_name = c_name,
    purchased_at = created_at = o_orderdate, rating from the priority.
    """
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .select(F.col("o_orderkey").alias("comment_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("o_orderdate").cast("timestamp").alias("purchased_at"),
                    F.col("o_orderdate").cast("timestamp").alias("created_at"),
                    rating_from_priority().alias("rating")))


def seller_sales(spark: SparkSession, d: str) -> DataFrame:
    """(comment_id = l_orderkey, seller_name = s_name) per line item."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name")
    return (li.join(s, li.l_suppkey == s.s_suppkey, "left")
            .select(F.col("l_orderkey").alias("comment_id"), F.col("s_name").alias("seller_name")))


def products(spark: SparkSession, d: str) -> DataFrame:
    """product_id = p_partkey, product_name = p_name."""
    return _t(spark, d, "part").select(F.col("p_partkey").alias("product_id"),
                                       F.col("p_name").alias("product_name"))


def product_lines(spark: SparkSession, d: str) -> DataFrame:
    """(comment_id = l_orderkey, product_id = l_partkey) per line item."""
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("comment_id"),
                                           F.col("l_partkey").alias("product_id"))


def burst_events(spark: SparkSession, d: str) -> DataFrame:
    """Burst-flag input: user = user_id, time = ts, id = event_id."""
    return _t(spark, d, "events").select(F.col("event_id").alias("comment_id"),
                                         F.col("user_id").alias("customer_id"),
                                         F.col("ts").cast("timestamp").alias("created_at_ts"))


def epoch_seconds(c: str) -> F.Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


def _commented_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with their order, customer and supplier: columns of the tables only.  A comment's
    texts are put together from them after the last join, so that no shuffle carries them."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_quantity", "l_shipdate", "l_returnflag")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                      "o_orderstatus")
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_name")
    # names go to orders first: there are fewer of them than lines
    return (li.join(o.join(c, o.o_custkey == c.c_custkey, "left"), li.l_orderkey == o.o_orderkey, "left")
            .join(s, li.l_suppkey == s.s_suppkey, "left"))


def _comment_columns() -> list[F.Column]:
    return [
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("comment_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        rating_from_priority().cast("string").alias("rating"),
        F.concat_ws(" ", F.lit("order"), F.col("o_orderstatus"), F.col("l_returnflag")).alias("title"),
        F.concat_ws(" ", F.col("o_orderpriority"), F.lit("qty"), F.col("l_quantity").cast("int")).alias("content"),
        epoch_seconds("l_shipdate").cast("string").alias("created_at"),
        epoch_seconds("o_orderdate").cast("string").alias("purchased_at"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_name"),
        F.col("l_quantity").alias("quantity"),
    ]


def raw_comments(spark: SparkSession, d: str) -> DataFrame:
    """Raw comment rows (duplicates kept) shaped like the crawler's CSV.

    One comment per line item: comment_id = l_orderkey * 8 + l_linenumber
    (line numbers are 1..7), product = l_partkey, customer = o_custkey,
    created_at = l_shipdate and purchased_at = o_orderdate as epoch seconds,
    rating from the order priority, content = the part's type and name,
    seller = the supplier.  (l_orderkey, l_linenumber) repeats in lineitem,
    so comment_id repeats too: the de-duplication input.
    """
    return _commented_lines(spark, d).select(*_comment_columns())


def raw_products(spark: SparkSession, d: str) -> DataFrame:
    """Raw product rows in the notebook's layout (key ``id``, name ``name``)."""
    return _t(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                       F.col("p_retailprice").alias("price"),
                                       F.col("p_brand").alias("brand_name"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    # dealt anew: a file gives at most one task per row group, and reading is the least of the work on texts
    return _t(spark, d, "documents").select("doc_id", "text").repartition("doc_id", "text")


def conversations(spark: SparkSession, d: str) -> DataFrame:
    """Per-user similarity input: user = conv_id, comment = turn, content = text."""
    return _t(spark, d, "conversations").select(F.col("conv_id").alias("customer_id"),
                                                F.col("turn").alias("comment_id"),
                                                F.col("text").alias("content"))


def brand_purchases(spark: SparkSession, d: str) -> DataFrame:
    """Mining input: (basket = order, item = brand, rating of the order)."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = _t(spark, d, "part").select("p_partkey", "p_brand")
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return (li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("customer_id"), F.col("p_brand").alias("product_id"),
                    rating_from_priority().alias("rating")))


def purchases(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour/recommendation input: (customer = o_custkey, product =
    l_partkey, rating from the priority, quantity, order, line)."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
                    F.col("l_quantity").alias("quantity"), rating_from_priority().alias("rating"),
                    F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line")))


def hot_baskets(spark: SparkSession, d: str) -> DataFrame:
    """Baskets with hot products: each customer's well-rated parts, and one product per order status
    (-1, -2, -3) that nearly all customers hold.  One row (customer_id, items) per customer."""
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("customer_id"),
                                      (-F.instr(F.lit("FOP"), F.col("o_orderstatus"))).cast("bigint").alias("product_id"))
    liked = purchases(spark, d).filter("rating >= 4").select("customer_id", F.col("product_id").cast("bigint").alias("product_id"))
    return o.unionByName(liked).groupBy("customer_id").agg(F.array_sort(F.collect_set("product_id")).alias("items"))


def customers(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))


def line_products(spark: SparkSession, d: str) -> DataFrame:
    """(comment_id, product_id, product_name) per line item (name source)."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = _t(spark, d, "part").select("p_partkey", "p_name")
    return (li.join(p, li.l_partkey == p.p_partkey, "left")
            .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("comment_id"),
                    F.col("l_partkey").alias("product_id"), F.col("p_name").alias("product_name")))


def dirty_comments(spark: SparkSession, d: str) -> DataFrame:
    """``raw_comments`` as a crawler lands them, so that every cleaning rule meets
    rows it changes:

    * comments on the lines of an urgent order (priority 1 or 2) come
      45 seconds apart, days after the purchase: runs of small gaps;
    * content names the product and its price, so texts differ within a customer;
      it is null, blank, or absent for some prices;
    * timestamps and ratings are dirty text for some suppliers and line counts.
    """
    p = _t(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size")
    lines = _commented_lines(spark, d)
    r = lines.join(p, lines.l_partkey == p.p_partkey, "left").select(*_comment_columns(), "p_name", "p_type", "p_size")
    line = F.pmod(F.col("comment_id"), F.lit(8))
    urgent = F.substring("content", 1, 1).isin("1", "2")
    burst = F.col("purchased_at").cast("bigint") + 86400 * (1 + F.pmod(F.col("customer_id"), F.lit(40))) + 45 * line
    created = (F.when(F.col("quantity") == 50, F.lit("n/a")).when(F.col("quantity") == 49, F.lit("-99999999999999"))
               .when(urgent, burst.cast("string")).otherwise(F.col("created_at")))
    content = (F.when(F.col("p_size") == 7, F.lit(None).cast("string")).when(F.col("p_size") == 8, F.lit("\n\t\u00a0"))
               .otherwise(F.concat_ws(" ", "content", "p_name", F.lower("p_type"), "seller_name", F.col("p_size").cast("string"))))
    rating = F.when(F.col("quantity") == 48, F.lit("five")).otherwise(F.col("rating"))
    name = F.when(F.col("quantity") == 47, F.lit(None).cast("string")).otherwise(F.col("customer_name"))
    return r.select(*[{"created_at": created, "content": content, "rating": rating, "customer_name": name}
                      .get(c, F.col(c)).alias(c) for c in r.columns if not c.startswith("p_")])


def comment_times(spark: SparkSession, d: str, seconds: int = 1) -> DataFrame:
    """Burst-flag input from the dirty comments: one row per comment and time that
    can be read, the time cut to ``seconds`` (90 gives gaps of zero)."""
    t = dirty_comments(spark, d).select("comment_id", "customer_id", epoch_to_timestamp("created_at").alias("created_at_ts")).distinct()
    cut = F.timestamp_seconds(F.floor(F.unix_seconds("created_at_ts") / seconds) * seconds)
    return t.filter(F.col("created_at_ts").isNotNull()).withColumn("created_at_ts", cut)


def flagged_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with fraud flags, true, false and null, and some rows without a
    customer or a purchase time (P9, P10)."""
    r = reviews(spark, d)
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("comment_id"), "o_orderstatus", "o_totalprice")
    j = r.join(o, "comment_id")
    return j.select(
        "comment_id", F.when(F.col("o_totalprice") >= 20000, F.col("customer_id")).alias("customer_id"), "customer_name",
        F.when(F.col("rating") != 3, F.col("purchased_at")).alias("purchased_at"), "created_at", "rating",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F").alias("F3_flag"),
        (F.col("rating") == 1).alias("F5_flag"))


def listed_products(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue that lacks the rings, so some recommended ids have no name."""
    p = products(spark, d)
    return p.filter(~F.col("product_name").contains("ring"))


def padded_conversations(spark: SparkSession, d: str) -> DataFrame:
    """``conversations`` with turns of white space only and without text."""
    c = _t(spark, d, "conversations")
    blank = F.when(F.col("turn") == 2, F.lit("\n\t")).when(F.col("turn") == 3, F.lit("\u00a0 \u2003")).when(
        F.col("turn") == 4, F.lit(None).cast("string")).otherwise(F.col("text"))
    return c.select(F.col("conv_id").alias("customer_id"), F.col("turn").alias("comment_id"), blank.alias("content"))


def escaped_conversations(spark: SparkSession, d: str) -> DataFrame:
    """``conversations`` as a web page would hold them: letters and blanks written as HTML
    references, one way of writing for each fifth of the turns (named with and without
    semicolon, decimal, hexadecimal, Windows bytes, unknown names, invalid numbers)."""
    t = F.col("text")

    def put(c: F.Column, *pairs: tuple[str, str | F.Column]) -> F.Column:
        for old, new in pairs:
            c = F.replace(c, F.lit(old), F.lit(new) if isinstance(new, str) else new)
        return c

    by_length = F.concat(F.lit("&#"), (F.length(t) * 97).cast("string"), F.lit(";"))
    forms = [put(t, ("e", "&eacute;"), (" ", "&nbsp;&ensp;")), put(t, ("a", "&#97"), ("o", "&#x6F;")),
             put(t, ("i", "&notit;"), (" the", "&ampthe&copy")), put(t, ("n", "&#150;"), ("s", by_length)),
             F.concat(F.lit("&lt;p&gt;"), put(t, (" ", "&CounterClockwiseContourIntegral;&no such;")), F.lit("&#x1F600;&#0;&#xD800;&#5;"))]
    text = F.get(F.array(*forms), F.pmod(F.col("turn"), F.lit(len(forms))).cast("int"))
    return _t(spark, d, "conversations").select("conv_id", "turn", text.alias("text"))


def review_json(spark: SparkSession, d: str) -> DataFrame:
    """Landed review documents (S4 input): each raw comment row as the
    crawler's nested JSON text, ``created_by`` and ``seller`` null when
    their key is null."""
    r = raw_comments(spark, d)
    doc = F.struct(
        F.col("comment_id").alias("id"), "product_id", "customer_id",
        F.col("rating").cast("double").alias("rating"), "title", "content",
        F.col("created_at").cast("bigint").alias("created_at"),
        F.when(F.col("customer_id").isNotNull(),
               F.struct(F.col("customer_id").alias("id"), F.col("customer_name").alias("name"),
                        F.col("purchased_at").cast("bigint").alias("purchased_at"))).alias("created_by"),
        F.when(F.col("seller_id").isNotNull(),
               F.struct(F.col("seller_id").alias("id"), F.col("seller_name").alias("name"))).alias("seller"))
    return r.select(F.to_json(doc).alias("json"))


def product_json(spark: SparkSession, d: str) -> DataFrame:
    """Landed product documents (S5 input) from ``part``; fields the part
    table lacks are absent from the text."""
    p = _t(spark, d, "part").select("p_partkey", "p_name", "p_retailprice", "p_brand", "p_type")
    doc = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                   F.col("p_retailprice").alias("price"), F.col("p_retailprice").alias("original_price"),
                   F.struct(F.col("p_brand").alias("name")).alias("brand"),
                   F.col("p_type").alias("short_description"))
    return p.select(F.to_json(doc).alias("json"))


def listing_json(spark: SparkSession, d: str) -> DataFrame:
    """Landed listing pages (S6 input): one page per order listing the part
    ids of its lines (at most seven), so ids repeat across pages."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    pages = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", F.struct(F.col("l_partkey").alias("id")).alias("d"))))
         .alias("lines"))
    return pages.select(F.to_json(F.struct(F.col("lines.d").alias("data"))).alias("json"))
