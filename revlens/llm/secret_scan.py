"""Secret scan with DataFrame functions only: three rules and a pair of Markov models.

Rules give the base spans.  The method adds every long token that a first-order
character model of random strings explains better than one of ordinary
identifiers: the summed log-likelihood ratio of its character pairs is at least
EVIDENCE.  Both models are trained on the tokens of the scanned table itself,
labelled by the rules: tokens inside a base span are secrets, tokens of letters
only are ordinary.  Pair counts come from all such tokens; a character's followers
lean on the frequency of all characters, and those on the uniform alphabet.

Positions: ``split`` by a rule gives the texts between its matches and
``regexp_extract_all`` the matches, so match starts are running sums of lengths,
taken by a window per row.  The text is read once; what is shuffled are matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import full_text, stored, table

# Fixed values of the contract: kinds in order, patterns, least lengths.
KINDS = ["assign", "access", "hex"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"   # of AKIA[A-Z0-9]+ those of 20 or more: a run of these characters has one match
HEX = r"[0-9a-f]{24,}"          # of [0-9a-f]+ those of 24 or more
LEAST_VALUE = 6
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]

METHOD = "markov"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
BACK_OFF = 4.0  # pseudo-counts with which a character's followers lean on all characters
EVIDENCE = 8.0  # nats: odds of about 3000 to 1


def _found(text: Column, pattern: str, group: int, when: Column) -> Column:
    """Matches as array<struct<gap, size, value>>: code points since the match before, own length, group text."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    spaced = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("gap"), F.length(m).alias("size")))
    full = F.zip_with(spaced, values, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), v.alias("value")))
    return F.when(when, full).otherwise(F.array().cast("array<struct<gap:int,size:int,value:string>>"))


def matched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, matches per kind): the one pass over the texts."""
    t = full_text(text)
    low = F.lower(t)
    assigned = F.lit(False)
    for word in KEYWORDS:
        assigned = assigned | F.contains(low, F.lit(word))
    return docs.select(F.col(key).alias("key"), t.alias("t"), assigned.alias("maybe")).select(
        F.monotonically_increasing_id().alias("row"), "key",
        _found(F.col("t"), ASSIGN, 1, F.col("maybe")).alias("assign"),
        _found(F.col("t"), ACCESS, 0, F.contains("t", F.lit("AKIA"))).alias("access"),
        _found(F.col("t"), HEX, 0, F.rlike("t", F.lit(HEX))).alias("hex"),
        _found(F.col("t"), TOKEN, 0, F.rlike("t", F.lit(TOKEN))).alias(METHOD))


def _spans(rows: DataFrame) -> DataFrame:
    """(row, kind, place, start, end, value), the base's failing matches dropped."""
    kinds = [*KINDS, METHOD]
    per_kind = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(k).alias("found")) for i, k in enumerate(kinds)])
    each = (rows.select("row", F.explode(per_kind).alias("k"))
            .select("row", F.col("k.kind").alias("kind"), F.posexplode("k.found").alias("place", "m")))
    past = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(past))
    return (placed.withColumn("start", F.col("end") - F.col("m.size"))
            .where((F.col("kind") != 0) | (F.length("m.value") >= LEAST_VALUE))
            .select("row", "kind", "place", "start", "end", F.col("m.value").alias("value")))


def _pairs(tokens: DataFrame) -> DataFrame:
    """Character pairs of each token: first, second."""
    return tokens.withColumn("at", F.explode(F.sequence(F.lit(1), F.length("value") - 1))).withColumns(
        {"first": F.substring("value", F.col("at"), F.lit(1)), "second": F.substring("value", F.col("at") + 1, F.lit(1))})


def ratios(labelled: DataFrame) -> DataFrame:
    """Tokens (value, secret) -> (first, second, ratio) for all pairs of the alphabet:
    log P(second | first) under random strings less that under ordinary ones."""
    spark = labelled.sparkSession
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    grid = spark.range(1).select(F.explode(letters).alias("first")).withColumn("second", F.explode(letters))
    seen = _pairs(labelled).groupBy("first", "second").agg(F.count_if(F.col("secret")).alias("n_random"),
                                                         F.count_if(~F.col("secret")).alias("n_ordinary"))
    full = grid.join(seen, ["first", "second"], "left").na.fill(0)
    row, column, grid_rows = Window.partitionBy("first"), Window.partitionBy("second"), Window.partitionBy(F.lit(0))

    def log_p(n: str) -> Column:
        anywhere = (F.sum(n).over(column) + 1) / (F.sum(n).over(grid_rows) + len(ALPHABET))
        return F.log((F.col(n) + BACK_OFF * anywhere) / (F.sum(n).over(row) + BACK_OFF))

    return full.select("first", "second", (log_p("n_random") - log_p("n_ordinary")).alias("ratio"))


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", evidence: float = EVIDENCE) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (row, key) and spans (row, kind number, start, end).

    Spans are in code points, end exclusive; kinds number ``assign``, ``access``,
    ``hex`` and the method's.  A method's span that overlaps a base span is left out."""
    rows = stored(matched(docs, key, text), "matches")
    spans = stored(_spans(rows), "spans")
    method = len(KINDS)
    ordered = Window.partitionBy("row").orderBy("start", "kind", "place")
    base = F.col("kind") < method
    before = F.max(F.when(base, F.col("end"))).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    inside = F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))
    tokens = spans.withColumn("inside", inside).where(~base)
    labelled = tokens.where(F.col("inside") | F.col("value").rlike("^[A-Za-z]+$")).select("value", F.col("inside").alias("secret"))
    model = stored(ratios(labelled), "model")
    # at most len(ALPHABET) ** 2 rows: a bounded broadcast
    scored = (_pairs(tokens.where(~F.col("inside"))).join(F.broadcast(model), ["first", "second"])
              .groupBy("row", "place", "kind", "start", "end").agg(F.round(F.sum("ratio"), 9).alias("llr")))
    added = scored.where(F.col("llr") >= evidence)
    return rows.select("row", "key"), spans.where(base).select("row", "kind", "start", "end").unionAll(
        added.select("row", "kind", "start", "end"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null text counts as empty; repeated rows are scanned each; texts without a
    span have counts 0 and empty lists; an empty table gives an empty table."""
    rows, spans = secret_spans(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in [*KINDS, METHOD]])
    listed = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))

    def text_of(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    full = rows.join(listed, "row", "left").withColumn("s", F.coalesce("s", none))
    base = F.filter("s", lambda x: x["kind"] < len(KINDS))
    counts = [F.size(F.expr(f"filter(s, x -> x.kind = {i})")).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS)]
    return full.select(F.col("key").alias("doc_id"), *counts,
                       F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"), text_of(F.col("s")).alias("spans"))
