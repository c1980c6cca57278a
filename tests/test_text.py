import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from revlens.functions import text as tx
from revlens.functions.html import unescape_html
from revlens.plans.catalog import QUERIES


def one(spark, expr_fn, value):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(expr_fn(F.col("t")).alias("o")).first()["o"]


def test_clean_text_abbreviations_adjacent_and_at_ends(spark):
    assert one(spark, tx.clean_text, "k ko dc") == "không không được"
    assert one(spark, tx.clean_text, "sp ok") == "sản_phẩm ổn"
    assert one(spark, tx.clean_text, "Shop giao hàng nhanh r") == "cửa_hàng giao hàng nhanh rồi"
    # not a whole word: untouched
    assert one(spark, tx.clean_text, "kok okay") == "kok okay"


def test_clean_text_urls_hashtags_vietnamese_emoji(spark):
    out = one(spark, tx.clean_text, "Hàng đẹp #đẹp @shop_vn xem https://x.vn/a?b=1 www.abc.com 😀!!!")
    # (?U)-style classes: the Vietnamese hashtag is removed as a whole
    assert out == "hàng đẹp xem"


def test_clean_text_null_and_blank(spark):
    assert one(spark, tx.clean_text, None) == ""
    assert one(spark, tx.clean_text, "   \n\t ") == ""


def test_clean_text_v2_keeps_case_and_hashtag_word(spark):
    out = one(spark, tx.clean_text_v2, "Tốt &amp; rẻ #ChấtLượng @bob 👍 http://a.b/c")
    assert out == "Tốt rẻ ChấtLượng"


def test_normalize_text_notebook_map(spark):
    assert one(spark, tx.normalize_text, "Hàng OK,đẹp ad rep nhanh") == "hàng ổn đẹp quản_trị_viên trả_lời nhanh"


def test_remove_stopwords(spark):
    assert one(spark, lambda c: tx.remove_stopwords(c, {"và", "thì"}), "hàng và giá thì tốt") == "hàng giá tốt"


def test_safe_csv_text(spark):
    assert one(spark, tx.safe_csv_text, 'a,b\r\n"c"  d') == "a b 'c' d"


def test_short_word_counts(spark):
    from revlens.operators.words import short_word_counts
    df = spark.createDataFrame([("a bb ccc a",), ("bb a xy",)], "content_text string")
    rows = [tuple(r) for r in short_word_counts(df, top_k=2).collect()]
    assert rows == [("a", 3), ("bb", 2)]


def test_unescape_html_equals_the_standard_library(spark):
    rng = random.Random(1)
    texts = [f"a&{n}b" for n in html5] + [f"&{n}" for n in html5] + [f"x &{n}; y" for n in html5 if not n.endswith(";")]
    numbers = [*range(400), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000,
               0x1FFFE, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10 ** 7, 10 ** 20]
    texts += [f"&#{n};" for n in numbers] + [f"&#x{n:x}" for n in numbers]
    texts += ["", "&", "&#;", "&#x;", "&&amp;", "a&amp;lt;", "&notit;", "&ampx;", "&no such;", "&" + "a" * 40 + ";",
              "&#00000000000065;", "&lt\n&gt", "caf&eacute &hellip; &copy2024"]
    texts += ["".join(rng.choice(["&", "amp", "#", "x", "3", "9", ";", "lt", "not", "in", " ", "é", "copy"]) for _ in range(12))
              for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(2)
    got = dict(df.select("i", unescape_html(F.col("t"))).collect())
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]
    assert one(spark, unescape_html, None) is None


def test_clean_text_v2_decodes_all_references(spark):
    assert one(spark, tx.clean_text_v2, "a&#243;b &eacute;t &copy; &hellip;") == "aób ét"


def test_classes_hold_the_same_characters(spark):
    points = spark.range(1, 0x110000).where("id < 55296 OR id > 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    pairs = [(f"[^{tx.WORD}{ws}]", tx._other_than(tx.WORD + ws)) for ws in (tx.ASCII_WS, tx.UNICODE_WS)]
    pairs += [(f"[{ws}]", tx._one_of(ws)) for ws in (tx.ASCII_WS, tx.UNICODE_WS)]
    assert points.where(F.array_contains(F.array(*[char.rlike(a) != char.rlike(b) for a, b in pairs]), True)).count() == 0


def test_texts_of_one_row_group_are_dealt_to_several_tasks(spark, tmp_dir):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(200)), lambda i: F.md5((F.col("id") * 1000 + i).cast("string"))))
    spark.range(2000).select(F.col("id").alias("doc_id"), words.alias("text")).coalesce(1).write.parquet(f"{tmp_dir}/documents.parquet")
    tasks = QUERIES["normalize_text"](spark, tmp_dir).select(F.spark_partition_id().alias("p"), "content_text").groupBy("p").count()
    rows = [r["count"] for r in tasks.collect()]
    assert len(rows) > 1 and sum(rows) == 2000


def test_safe_and_clean_text_search_little_and_give_the_same(spark):
    rng = random.Random(17)
    pieces = ["ko", "shop", "x", "été", "#tag", "@me", "http://a b", "www.c", "\"", ",", "-", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\f", "\x85", " ", " ", "😀", "_", "a  b"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(400)] + [None]
    c = F.col("t")
    # step by step, each search over every text
    plain = F.coalesce(c, F.lit(""))
    squeezed = lambda x: F.trim(F.regexp_replace(x, "[ \\t\\n\\x0B\\f\\r]+", " "))
    safe = squeezed(F.replace(F.replace(F.regexp_replace(plain, "[\\r\\n]+", " "), F.lit('"'), F.lit("'")), F.lit(","), F.lit(" ")))
    words = F.regexp_replace(F.lower(plain), f"http[^{tx.ASCII_WS}]+|www[^{tx.ASCII_WS}]+", " ")
    words = F.regexp_replace(words, f"[@#][{tx.WORD}]+", " ")
    words = F.split(squeezed(F.regexp_replace(words, f"[^{tx.WORD}{tx.ASCII_WS}]", " ")), " ")
    lookup = F.create_map(*[F.lit(x) for kv in tx.ABBREVIATIONS_JOB.items() for x in kv])
    clean = squeezed(F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(lookup, w), w)), " "))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", safe.alias("a"), tx.safe_csv_text(c).alias("b"), clean.alias("x"), tx.clean_text(c).alias("y")).collect()
    assert len(rows) == len(texts)
    assert [(r.t, r.a, r.x) for r in rows] == [(r.t, r.b, r.y) for r in rows]

    def searches(column):  # those made whatever the text
        plan = df.select(column.alias("o"))._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("regexp_replace(") - plan.count("THEN regexp_replace(")
    assert searches(tx.safe_csv_text(c)) == 0
    assert searches(tx.clean_text(c)) == 1
