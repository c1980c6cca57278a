"""Per-user comment similarity flag.

For every user with at least two non-blank comments, TF-IDF is fitted on
that user's comments alone (tokens: runs of two or more letters, digits or
underscores, lower-cased; idf = ln((1 + n) / (1 + df)) + 1; rows L2
normalised), and the cosine similarity of every pair of comments gives a
mean and a max.  A user without any token gets no values.

Users are small groups as a rule: one whose comments times characters stay within
GROUPED is one row of hashed terms, and its matrix is worked out in place
(``_within_users``), so the text is shuffled once and no term becomes a row.

Plan for the users beyond that bound (``_across_tasks``):
* tf, df and norms are grouped aggregates (partial aggregation; AQE splits
  skewed join partitions), no per-user Python.  The vectors are written once,
  one row per comment; every later step reads them.
* The mean needs no pairs: sum over pairs i<j of v_i.v_j equals
  (|sum_i v_i|^2 - sum_i |v_i|^2) / 2, i.e. per (user, term) sums of the
  normalised weights, squared and added.
* The max needs pairs, but only for users without a copied comment (a copy
  means max 1.0, found by grouping identical normalised vectors), and only
  candidates from a prefix index on both sides (``_best_pairs``): exact, and
  frequent words do not generate pairs once a lower bound is known.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import UNICODE_WS
from revlens.session import cut_lineage

TOKEN = r"[\p{L}\p{N}_]{2,}"
GROUPED = 6_000_000  # comments x characters of a user that is worked out in place: two million entries of a matrix at most


def _nonblank(comments: DataFrame, text: str) -> DataFrame:
    return comments.filter(F.coalesce(F.col(text), F.lit("")).rlike(f"[^{UNICODE_WS}]"))


def tfidf_vectors(comments: DataFrame, user: str = "customer_id", cid: str = "comment_id",
                  text: str = "content", materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """(vectors, users): one row (user, cid, vec) per comment with tokens, and (user, n)
    non-blank comment counts.

    ``vec`` holds the L2-normalised TF-IDF entries fitted per user, rare-first (df, then
    term): df, term, v, the smallest and largest comment holding the term (c1, c2), and
    ``rem``, the norm of the entries from this one on."""
    nb = _nonblank(comments, text)
    users = nb.groupBy(user).agg(F.count("*").alias("n"))
    tok = nb.select(user, cid, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), 0)).alias("term"))
    tf = tok.groupBy(user, cid, "term").agg(F.count("*").alias("tf"))
    if materialize:
        tf = cut_lineage(tf)  # read twice: for the term counts and for the entries
    df = tf.groupBy(user, "term").agg(F.count("*").alias("df"), F.min(cid).alias("c1"), F.max(cid).alias("c2"))
    weight = F.col("tf") * (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1.0)
    rows = (tf.join(df, [user, "term"]).join(users.filter(F.col("n") >= 2), user)
              .groupBy(user, cid).agg(F.array_sort(F.collect_list(F.struct("df", "term", weight.alias("w"), "c1", "c2"))).alias("es")))
    # sums of squares from the last (most frequent) term back, so the norms need no second pass
    back = F.aggregate(F.reverse("es"), F.array().cast("array<double>"), lambda acc, x: F.concat(
        acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + x["w"] * x["w"])))
    rows = rows.withColumn("rems", F.reverse(back)).withColumn("nrm", F.sqrt(F.col("rems")[0]))
    vec = F.zip_with("es", "rems", lambda x, r: F.struct(
        x["df"].alias("df"), x["term"].alias("term"), (x["w"] / F.col("nrm")).alias("v"),
        x["c1"].alias("c1"), x["c2"].alias("c2"), (F.sqrt(r) / F.col("nrm")).alias("rem")))
    return rows.select(user, cid, vec.alias("vec")), users


def user_text_similarity(comments: DataFrame, user: str = "customer_id", cid: str = "comment_id",
                         text: str = "content", materialize: bool = True, grouped: int = GROUPED) -> DataFrame:
    """One row per user of the input: (user, mean_similarity, max_similarity).

    Users with more than ``grouped`` comments x characters are spread over the tasks, the
    others are worked out in place; ``grouped`` changes the plan, never the result.  With
    ``materialize`` the list of the former is written once, and so are their vectors."""
    nb = _nonblank(comments, text).select(user, cid, text)
    large = (nb.groupBy(user).agg(F.count("*").alias("n"), F.sum(F.length(text)).alias("chars"))
             .filter(F.col("n").cast("double") * F.col("chars") > grouped).select(user))
    if materialize:
        large = cut_lineage(large)
    if materialize and large.isEmpty():
        stats = _within_users(nb, user, cid, text)
    else:
        stats = (_within_users(nb.join(large, user, "left_anti"), user, cid, text)
                 .unionByName(_across_tasks(nb.join(large, user, "left_semi"), user, cid, text, materialize)))
    everyone = comments.select(user).distinct()
    return everyone.join(stats, user, "left")


def _within_users(nb: DataFrame, user: str, cid: str, text: str) -> DataFrame:
    """(user, mean_similarity, max_similarity) of the users with two non-blank comments and a token;
    one row a user, terms as 64-bit hashes."""
    def similarity_of(n: int, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray) -> tuple[float, float]:
        """(mean, max) cosine of one user's ``n`` comments: ``sizes`` terms each, comments of one id are one."""
        doc = np.unique(np.repeat(ids, sizes), return_inverse=True)[1]
        words, word = np.unique(terms, return_inverse=True)
        m = int(doc.max()) + 1
        tf = np.bincount(doc * len(words) + word, minlength=m * len(words)).reshape(m, len(words))
        w = tf * (np.log((n + 1.0) / ((tf > 0).sum(axis=0) + 1.0)) + 1.0)
        w /= np.sqrt((w * w).sum(axis=1))[:, None]
        total = w.sum(axis=0)
        cosines = w @ w.T
        np.fill_diagonal(cosines, 0.0)
        top = float(cosines.max())
        return max(0.0, (float(total @ total) - m) / (n * (n - 1))), 1.0 if top > 1 - 1e-12 else max(0.0, top)

    @F.pandas_udf("mean_similarity double, max_similarity double")
    def measure(n: pd.Series, ids: pd.Series, sizes: pd.Series, terms: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([similarity_of(*x) for x in zip(n, ids, sizes, terms)], columns=["mean_similarity", "max_similarity"])

    hashed = F.transform(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), 0), lambda t: F.xxhash64(t))
    rows = nb.repartition(user).select(user, F.struct(F.xxhash64(cid).alias("id"), hashed.alias("terms")).alias("c"))
    held = rows.groupBy(user).agg(F.count("*").alias("n"), F.collect_list("c").alias("cs")).filter(F.col("n") >= 2)
    held = held.select(user, "n", F.transform("cs", lambda c: c["id"]).alias("ids"),
                       F.transform("cs", lambda c: F.size(c["terms"])).alias("sizes"), F.flatten("cs.terms").alias("terms"))
    return held.filter(F.size("terms") > 0).select(user, measure("n", "ids", "sizes", "terms").alias("s")).select(user, "s.*")


def _across_tasks(comments: DataFrame, user: str, cid: str, text: str, materialize: bool) -> DataFrame:
    """The same for users of any size.  With ``materialize`` the vectors are written once; the
    mean, the copy detection and the pair search all read them."""
    vectors, users = tfidf_vectors(comments, user, cid, text, materialize)
    if materialize:
        vectors = cut_lineage(vectors)
    entries = vectors.select(user, F.explode("vec").alias("e")).select(user, "e.term", "e.v")
    # mean: linear in the per-(user, term) sums of v
    sums = entries.groupBy(user, "term").agg(F.sum("v").alias("s"))
    sq = sums.groupBy(user).agg(F.sum(F.col("s") * F.col("s")).alias("sq"))
    # a user with a copied comment has max 1.0: only the others need pairs
    sig = F.transform("vec", lambda e: F.struct(e["term"], F.round(e["v"], 9)))
    copies = vectors.groupBy(user, sig.alias("sig")).agg(F.count("*").alias("copies"))
    dup = copies.groupBy(user).agg(F.sum("copies").alias("m"), F.max(F.col("copies") >= 2).alias("has_copy"))
    if materialize:
        dup = cut_lineage(dup)
    searched = vectors.join(dup.filter(~F.col("has_copy") & (F.col("m") >= 2)).select(user), user, "left_semi")
    pmax = _best_pairs(searched, user, cid, materialize).groupBy(user).agg(F.max("sim").alias("pmax"))
    return (users.join(dup, user).join(sq, user).join(pmax, user, "left")
                 .filter(F.col("n") >= 2)
                 .select(user,
                         F.greatest(F.lit(0.0), (F.col("sq") - F.col("m")) / (F.col("n") * (F.col("n") - 1)))
                         .alias("mean_similarity"),
                         F.greatest(F.coalesce("pmax", F.lit(0.0)),
                                    F.when(F.col("has_copy"), F.lit(1.0)).otherwise(F.lit(0.0)))
                         .alias("max_similarity")))


def _cosines(pairs: DataFrame, vectors: DataFrame, user: str, cid: str) -> DataFrame:
    """Exact cosine of candidate pairs (user, i, j), in place from the two vectors."""
    lean = vectors.select(user, cid, F.transform("vec", lambda e: F.struct(e["term"], e["v"])).alias("x"))
    vi = lean.select(user, F.col(cid).alias("i"), F.col("x").alias("vi"))
    vj = lean.select(user, F.col(cid).alias("j"), F.map_from_entries("x").alias("vj"))
    dot = F.aggregate("vi", F.lit(0.0), lambda acc, e: acc + e["v"] * F.coalesce(F.try_element_at("vj", e["term"]), F.lit(0.0)))
    return pairs.join(vi, [user, "i"]).join(vj, [user, "j"]).select(user, "i", "j", dot.alias("sim"))


def bounds(vectors: DataFrame, user: str, cid: str) -> DataFrame:
    """(user, i, j, sim): each comment with another holder of its rarest shared term and of
    its second rarest.  The best of a user is the lower bound of its pair search; no pair
    list is made for it."""
    other = lambda e: F.when(e["c1"] != F.col(cid), e["c1"]).otherwise(e["c2"])
    near = F.array_distinct(F.slice(F.transform(F.filter("vec", lambda e: e["df"] >= 2), other), 1, 2))
    seeds = vectors.select(user, F.col(cid).alias("a"), F.explode(near).alias("b"))
    return _cosines(seeds.select(user, F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).distinct(), vectors, user, cid)


def prefix_entries(vectors: DataFrame, low: DataFrame, user: str, cid: str, eps: float = 1e-9) -> DataFrame:
    """(user, cid, low, term, rem): the entries whose remaining norm reaches the user's bound
    ``low``.  A term that only one comment holds can give no pair and is left out."""
    kept = F.filter("vec", lambda e: (e["df"] >= 2) & (e["rem"] >= F.col("low") - eps))
    return vectors.join(low, user).select(user, cid, "low", F.explode(kept).alias("e")).select(user, cid, "low", "e.term", "e.rem")


def _best_pairs(vectors: DataFrame, user: str, cid: str, materialize: bool = True, eps: float = 1e-9) -> DataFrame:
    """Pairs (user, i, j, sim) that are sure to hold each user's most similar pair.

    Let t be the first common term of two comments in the rare-first order.  Their cosine
    is at most rem_i(t) * rem_j(t), so a pair that reaches the user's bound L meets at a term
    where both remaining norms, and their product, reach L: prefixes join prefixes, and
    neither side brings its frequent words.  Rows are dealt by (user, term), so a
    busy user's posting lists spread over the tasks.
    """
    seeds = bounds(vectors, user, cid)
    if materialize:
        seeds = cut_lineage(seeds)
    low = seeds.groupBy(user).agg(F.max("sim").alias("low"))
    prefix = prefix_entries(vectors, low, user, cid, eps)
    a = prefix.select(user, "term", "low", F.col(cid).alias("i"), F.col("rem").alias("ri"))
    b = prefix.select(user, "term", F.col(cid).alias("j"), F.col("rem").alias("rj"))
    near = (a.join(b, [user, "term"]).filter((F.col("i") < F.col("j")) & (F.col("ri") * F.col("rj") >= F.col("low") - eps))
             .select(user, "i", "j").distinct())
    return _cosines(near, vectors, user, cid).unionByName(seeds)


def similarity_thresholds(sim: DataFrame) -> DataFrame:
    """One row: mean + sample std of the per-user means and maxima."""
    ok = sim.filter(F.col("mean_similarity").isNotNull() & F.col("max_similarity").isNotNull())
    return ok.agg((F.avg("mean_similarity") + F.stddev_samp("mean_similarity")).alias("threshold_mean"),
                  (F.avg("max_similarity") + F.stddev_samp("max_similarity")).alias("threshold_max"))


def flag_similarity(sim: DataFrame, thresholds: DataFrame | None = None, digits: int | None = 6) -> DataFrame:
    """``F4_Flag`` = mean >= threshold_mean or max >= threshold_max
    (users without values are not flagged).  Values are rounded to
    ``digits`` after flagging."""
    th = thresholds if thresholds is not None else similarity_thresholds(sim)
    t = th.select(F.struct("threshold_mean", "threshold_max")).scalar()
    flag = F.coalesce((F.col("mean_similarity") >= t["threshold_mean"])
                      | (F.col("max_similarity") >= t["threshold_max"]), F.lit(False))
    out = sim.withColumn("F4_Flag", flag)
    if digits is not None:
        out = (out.withColumn("mean_similarity", F.round("mean_similarity", digits))
                  .withColumn("max_similarity", F.round("max_similarity", digits)))
    return out


def similarity_flags(comments: DataFrame, user: str = "customer_id", cid: str = "comment_id",
                     text: str = "content", materialize: bool = True) -> DataFrame:
    """X4 + X5 + X6: (user, mean_similarity, max_similarity, F4_Flag).

    With ``materialize`` the per-user table is checkpointed once: both the
    thresholds and the flags read it.
    """
    sim = user_text_similarity(comments, user, cid, text, materialize)
    if materialize:
        sim = cut_lineage(sim)
    return flag_similarity(sim)


def comments_per_user(comments: DataFrame, user: str = "customer_id", cid: str = "comment_id",
                      text: str = "content") -> DataFrame:
    """Each user's comments with the user's comment count, ordered by
    user then comment: the grouped list kept as rows, so no user's comments
    are gathered into one array."""
    counts = comments.groupBy(user).agg(F.count("*").alias("n_comments"))
    return comments.select(user, cid, text).join(counts, user).orderBy(user, cid)
