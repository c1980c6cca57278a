"""Toxicity by the nearest labelled examples.

Fitting reads at most MAX_EXAMPLES labelled rows (those with the smallest id
hash).  Words are known by 64-bit hashes, so the vocabulary is one sorted array of numbers
on the driver and in the tasks; the index over the examples is built in one task,
which MAX_EXAMPLES bounds, and the driver passes it on packed.  Examples are TF-IDF vectors of unit length in two spaces; document frequencies
come from the whole corpus.

All words of the examples span the first, so that whoever repeats or resembles a
labelled text finds it, whatever its words.  Frequent words are a dense matrix, the
others an inverted index; a text is scored against every example, and the k nearest
are taken from the blocks whose largest cosine reaches the k-th.  Terms that mark toxic
texts, LIFT times the usual rate and beyond chance by the log-likelihood ratio against
the number of terms tried, span the second, where one telling word in a long text is
not outweighed; copies of a passage count once there, as terms are judged by the
distinct words they follow.  There every term stores its largest weight per block of
neighbouring examples, and scoring takes the blocks in order of their upper bound and
stops when no block can beat the k-th cosine found.

Both give the exact k nearest.  Cosines of the first are rounded to DIGITS decimals, so that
the order in which a batch happens to be summed does not show in a score.  The votes are weighted by cosine and drawn towards
the rate of examples without any term of the space; the higher score counts.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import full_text, stored, table
from .jaccard_join import words_of

MAX_EXAMPLES = 20_000   # bound of the labelled sample that is fitted
LIFT = 2.0              # a term's texts must be toxic this many times as often as texts are
NEIGHBOURS = 15
EVIDENCE = 5
BLOCK = 64
HELD_OUT = 5            # rows whose crc32(id) mod HELD_OUT is 0 are never learned from
REJECT = 0.5
DENSE = 0.1             # share of the examples from which a word is a column of the matrix
AT_ONCE = 128           # texts scored together
COUNTED = 512           # texts whose words are counted at a time
DIGITS = 9              # decimals of a cosine


def word_ids(words: list[bytes]) -> np.ndarray:
    """64-bit ids of words."""
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


Bag = tuple[np.ndarray, np.ndarray]  # distinct word ids, ascending, and their counts


def bag_of(words: list[bytes]) -> Bag:
    found = Counter(words)
    ids = word_ids(list(found))
    order = np.argsort(ids)
    return ids[order], np.fromiter(found.values(), np.int64, len(found))[order]


def places_of(ids: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the sorted vocabulary, whether it is there) of each id."""
    if not len(vocabulary):
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    at = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
    return at, vocabulary[at] == ids


class BlockMaxIndex:
    """Exact top-k cosine search over unit vectors with block-max pruning."""

    def __init__(self, vectors: list[dict[int, float]], payload: list, terms: int, block: int = BLOCK):
        # alike examples side by side: tight block maxima
        order = sorted(range(len(vectors)), key=lambda i: (sorted(vectors[i].items(), key=lambda x: -x[1]), payload[i][0]))
        self.payload = [payload[i] for i in order]
        self.block, self.blocks = block, -(-len(vectors) // block)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(terms)]
        for place, i in enumerate(order):
            for term, weight in vectors[i].items():
                lists[term].append((place, weight))
        self.places = [np.array([p for p, _ in x], np.int64) for x in lists]
        self.weights = [np.array([w for _, w in x], np.float64) for x in lists]
        self.block_max = np.zeros((terms, self.blocks))
        for term, (p, w) in enumerate(zip(self.places, self.weights)):
            np.maximum.at(self.block_max[term], p // block, w)
        # where each block begins in a term's list
        self.starts = [np.searchsorted(p, np.arange(self.blocks + 1) * block).tolist() for p in self.places]

    def nearest(self, query: dict[int, float], k: int) -> list[tuple[float, int]]:
        """(cosine, place) of the k examples with the largest positive cosines."""
        if not query or not self.blocks:
            return []
        terms = sorted(query)
        bound = np.array([query[t] for t in terms]) @ self.block_max[terms]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            limit = bound[b] * (1 + 1e-12)
            if limit <= 0 or len(best) == k and limit <= -best[-1][0]:
                break
            score = np.zeros(self.block)
            low = b * self.block
            for t in terms:
                a, z = self.starts[t][b], self.starts[t][b + 1]
                score[self.places[t][a:z] - low] += query[t] * self.weights[t][a:z]
            found = np.flatnonzero(score > 0)
            best = sorted(best + [(-float(score[i]), int(low + i)) for i in found])[:k]
        return [(-c, p) for c, p in best]


class WholeSpace:
    """Exact top-k cosine search over the examples' vectors of all their words."""

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]],
                 block: int = BLOCK):
        self.vocabulary, self.idf = vocabulary, idf
        bare = [toxic for _, toxic, terms, _ in examples if not len(terms)]
        self.prior = (sum(bare) + 0.05) / (len(bare) + 1)
        held = sorted((x for x in examples if len(x[2])), key=lambda x: x[0])
        self.ids, self.toxic = [x[0] for x in held], np.array([x[1] for x in held], bool)
        self.n, self.block = len(held), block
        if not held:
            return
        # what is kept and shipped are places and codes of counts; weights follow from them
        terms = np.concatenate([x[2] for x in held])
        counts, codes = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True)
        self.factor = np.append(0.0, 1 + np.log(counts))
        self.code_bits = len(counts).bit_length()
        codes = (codes + 1).astype(np.min_scalar_type(len(counts)))
        self.norm = np.array([math.sqrt(((self.factor[c] * idf[t]) ** 2).sum()) for t, c in zip(
            (x[2] for x in held), np.split(codes, np.cumsum([len(x[2]) for x in held[:-1]])))])
        places = np.repeat(np.arange(self.n, dtype=np.min_scalar_type(self.n)), [len(x[2]) for x in held])
        common = np.bincount(terms, minlength=len(idf)) >= max(2, DENSE * self.n)
        self.common = np.flatnonzero(common)
        self.column = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
        dense = common[terms]
        self.held = np.zeros((len(self.common), self.n), codes.dtype)
        self.held[self.column[terms[dense]], places[dense]] = codes[dense]
        terms, places, codes = terms[~dense], places[~dense], codes[~dense]
        order = np.argsort(terms, kind="stable")
        self.places, self.codes = places[order], codes[order]
        self.bounds = np.searchsorted(terms[order], np.arange(len(idf) + 1))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("matrix", "entries")}

    @cached_property
    def matrix(self) -> np.ndarray:
        return self.factor[self.held] * self.idf[self.common][:, None] / self.norm

    @cached_property
    def entries(self) -> np.ndarray:
        """The inverted index, a place and a code in one number: a text reads many short
        stretches of it, each once."""
        packed = self.places.astype(np.int64) << self.code_bits | self.codes
        return packed.astype(np.min_scalar_type(self.n << self.code_bits))

    def rare(self, low: np.ndarray, high: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per example the sum over stretches of the inverted index, of terms of these weights."""
        entries = self.entries
        packed = np.concatenate([entries[a:z] for a, z in zip(low.tolist(), high.tolist())])
        places = (packed >> self.code_bits).astype(np.intp)
        # in place of an index, as codes are known to be in range
        values = self.factor.take((packed & ((1 << self.code_bits) - 1)).astype(np.intp), mode="clip")
        values *= np.repeat(weights, high - low)
        return np.bincount(places, values, self.n) / self.norm

    def vector(self, bag: Bag) -> tuple[np.ndarray, np.ndarray]:
        terms, known = places_of(bag[0], self.vocabulary)
        if not known.any():
            return np.empty(0, np.int64), np.empty(0)
        terms, n = terms[known], bag[1][known]
        weights = (1 + np.log(n)) * self.idf[terms]
        return terms, weights / math.sqrt(weights @ weights)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """Per query (cosine, place) of the k examples with the largest positive cosines."""
        if not self.n:
            return [[] for _ in queries]
        asked = np.zeros((len(queries), len(self.matrix)))
        for i, (terms, weights) in enumerate(queries):
            column = self.column[terms]
            asked[i, column[column >= 0]] = weights[column >= 0]
        scores = asked @ self.matrix
        out = []
        for score, (terms, weights) in zip(scores, queries):
            rare = terms[self.column[terms] < 0]
            low, high = self.bounds[rare], self.bounds[rare + 1]
            if (high - low).sum():
                score += self.rare(low, high, weights[self.column[terms] < 0] * self.idf[rare])
            best = np.maximum.reduceat(score, np.arange(0, self.n, self.block))
            # k blocks reach this cosine, so the k-th does
            least = np.partition(best, -k)[-k] if len(best) >= k else 0.0
            found = np.flatnonzero(score >= least - 10.0 ** -DIGITS)
            cosines = np.round(score[found], DIGITS)
            order = np.lexsort((found, -cosines))[:k]
            out.append([(float(c), int(p)) for c, p in zip(cosines[order], found[order]) if c > 0])
        return out

    def judge(self, texts: list[Bag]) -> list[tuple[float, list[int], list[float]]]:
        """Per text (score, evidence ids, their cosines)."""
        out = []
        for at in range(0, len(texts), AT_ONCE):
            for near in self.nearest([self.vector(c) for c in texts[at:at + AT_ONCE]], NEIGHBOURS):
                toxic = sum(c for c, p in near if self.toxic[p])
                shown = near[:EVIDENCE]
                out.append(((toxic + self.prior) / (sum(c for c, _ in near) + 1), [self.ids[p] for _, p in shown], [c for c, _ in shown]))
        return out


class Model:
    """Vocabulary, index and prior of the marking terms (word ids), bounded by the words of
    MAX_EXAMPLES texts, and the space of all words."""

    whole: WholeSpace | None = None

    def __init__(self, idf: dict[int, float], examples: list[tuple[int, int, dict[int, int]]]):
        self.vocabulary = {t: i for i, t in enumerate(sorted(idf))}
        self.marks = np.array(sorted(idf), np.int64)
        self.idf = np.array([idf[t] for t in sorted(idf)])
        vectors, payload, bare, bare_toxic = [], [], 0, 0
        for doc, toxic, counts in examples:
            vector = self.vector(counts)
            if vector:
                vectors.append(vector)
                payload.append((doc, toxic))
            else:
                bare, bare_toxic = bare + 1, bare_toxic + toxic
        self.prior = (bare_toxic + 0.05) / (bare + 1)
        self.index = BlockMaxIndex(vectors, payload, len(self.vocabulary))

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        raw = {self.vocabulary[t]: (1 + math.log(n)) * self.idf[self.vocabulary[t]] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()} if norm else {}

    def counts(self, bag: Bag) -> dict[int, int]:
        there = places_of(bag[0], self.marks)[1]
        return dict(zip(bag[0][there].tolist(), bag[1][there].tolist()))

    def judge(self, counts: dict[int, int]) -> tuple[float, list[int], list[float]]:
        """(score, evidence ids, their cosines)."""
        near = self.index.nearest(self.vector(counts), NEIGHBOURS)
        votes = sum(c for c, _ in near)
        toxic = sum(c for c, p in near if self.index.payload[p][1])
        shown = near[:EVIDENCE]
        return ((toxic + self.prior) / (votes + 1), [self.index.payload[p][0] for _, p in shown], [c for c, _ in shown])


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def _g2(n: np.ndarray, toxic: np.ndarray, docs: int, toxic_docs: int) -> np.ndarray:
    """Log-likelihood ratio of each term's 2 x 2 table against the labels."""
    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    rate = toxic_docs / docs
    return 2 * (part(toxic, n * rate) + part(n - toxic, n * (1 - rate))
                + part(toxic_docs - toxic, (docs - n) * rate)
                + part(docs - toxic_docs - n + toxic, (docs - n) * (1 - rate)))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic",
        max_examples: int = MAX_EXAMPLES) -> Model | Fitted:
    """Learn from the labelled rows that are not held out, at most ``max_examples``.

    Rows without a label, a key or a text in ``docs`` are left out; a key labelled
    twice counts as toxic if any label says so; of several texts under one key the one
    with the smallest digest is learned.  Without any example the model
    knows only a low prior."""
    spark = docs.sparkSession
    chosen = (labels.where(F.col(key).isNotNull() & F.col(toxic).isNotNull() & ~held_out(key))
              .groupBy(F.col(key).alias("id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
              .orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_examples))
    # at most max_examples (id, label) rows: a bounded broadcast
    sample = stored(docs.select(F.col(key).alias("id"), full_text(text).alias("text"))
                    .join(F.broadcast(chosen), "id").groupBy("id", "toxic")
                    .agg(F.min(F.struct(F.md5("text").alias("digest"), "text"))["text"].alias("text")), "labelled")

    def term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, marked = Counter(), Counter()
        for batch in batches:
            for content, y in zip(batch["text"], batch["toxic"]):
                words = set(words_of(content))
                every.update(words)
                if y:
                    marked.update(words)
        yield pd.DataFrame({"term": word_ids(list(every)), "n": list(every.values()), "n_toxic": [marked[t] for t in every]})

    n_docs, n_toxic = sample.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    every = stored(sample.mapInPandas(term_counts, "term long, n long, n_toxic long")
                   .groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")), "terms")
    terms = every.where("n >= 3")
    tried = terms.count()
    if not n_docs or not n_toxic or n_toxic == n_docs:
        return Model({}, [(r["id"], r["toxic"], {}) for r in sample.select("id", "toxic").collect()])
    score = F.pandas_udf(lambda n, t: pd.Series(_g2(n.to_numpy(float), t.to_numpy(float), n_docs, n_toxic)), "double")
    telling = (F.col("g2") > 2 * math.log(max(1, tried))) & (F.col("n_toxic") * n_docs >= LIFT * n_toxic * F.col("n"))

    def best(counts: DataFrame) -> set[int]:
        # words of max_examples texts that are beyond chance
        return {r["term"] for r in counts.withColumn("g2", score("n", "n_toxic")).where(telling).select("term").collect()}

    marked_terms = spark.sparkContext.broadcast(frozenset(best(terms)))

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, seen = marked_terms.value, set()
        for batch in batches:
            for content, y in zip(batch["text"], batch["toxic"]):
                words = word_ids(words_of(content)).tolist()
                seen.update((w, words[i - 1] if i else 0, y) for i, w in enumerate(words) if w in known)
        yield pd.DataFrame(list(seen), columns=["term", "before", "toxic"])

    # copies of a passage count once: a term is tried again on the distinct words before it
    found = sample.mapInPandas(contexts, "term long, before long, toxic int").distinct()
    marking = best(found.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("n_toxic")))

    # the words of at most max_examples texts, eight bytes each
    words = np.sort(_numbers(every.select("term"))[0])
    vocabulary = spark.sparkContext.broadcast(words)

    def corpus_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, n = vocabulary.value, 0
        seen = np.zeros(len(known), np.int64)
        for batch in batches:
            n += len(batch)
            for content in batch["text"]:
                at, there = places_of(np.sort(word_ids(list(set(words_of(content))))), known)
                seen[at[there]] += 1  # distinct words, distinct places
        held = np.flatnonzero(seen)
        yield pd.DataFrame({"term": np.append(-1, held), "n": np.append(n, seen[held])})  # term -1 counts rows

    found = (docs.select(full_text(text).alias("text")).mapInPandas(corpus_counts, "term int, n long")
             .groupBy("term").agg(F.sum("n").alias("n")))
    places, counts = _numbers(found)
    # places are those of all words and -1: each count goes to its place
    df = np.zeros(len(words) + 1)
    df[places + 1] = counts
    idf = np.log(1 + int(df[0]) / df[1:])

    learned = spark.sparkContext.broadcast((idf, np.isin(words, np.array(sorted(marking), np.int64))))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The model of the sample, in one task: bounded by max_examples."""
        known, (idf, marks) = vocabulary.value, learned.value
        ids = known.tolist()
        whole, marked = [], []
        for batch in batches:
            for doc, y, content in zip(batch["id"].tolist(), batch["toxic"].tolist(), batch["text"]):
                found = Counter(words_of(content))
                terms = places_of(word_ids(list(found)), known)[0]
                order = np.argsort(terms)
                terms, counts = terms[order].astype("<i4"), np.fromiter(found.values(), "<i4", len(found))[order]
                whole.append((doc, y, terms, counts))
                marked.append((doc, y, {ids[t]: int(n) for t, n in zip(terms[marks[terms]], counts[marks[terms]])}))
        by_id = sorted(range(len(whole)), key=lambda i: whole[i][0])
        model = Model({ids[t]: float(idf[t]) for t in np.flatnonzero(marks)}, [marked[i] for i in by_id])
        model.whole = WholeSpace(known, idf, [whole[i] for i in by_id])
        yield pd.DataFrame({"model": [zlib.compress(pickle.dumps(model), 1)]})

    return Fitted(bytes(sample.coalesce(1).mapInPandas(build, "model binary").first()["model"]))


class Fitted:
    """A model as the bytes in which its task packed it; the driver only passes them on."""

    def __init__(self, data: bytes):
        self.data = data

    def __getstate__(self) -> dict:
        return {"data": self.data}

    @cached_property
    def model(self) -> Model:
        return pickle.loads(zlib.decompress(self.data))


def _numbers(rows: DataFrame) -> list[np.ndarray]:
    """The columns of rows without nulls, which come as Arrow batches: a number is never an object."""
    return [column.to_numpy() for column in rows.toArrow().columns]


def scorer(model: Model | Fitted, spark: SparkSession):
    """Column function: text -> struct(score, evidence, cosines)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence array<long>, cosines array<double>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        known: Model = shared.value.model if isinstance(shared.value, Fitted) else shared.value
        marked: dict[frozenset, tuple] = {}
        out: list[tuple] = []
        for at in range(0, len(texts), COUNTED):  # word counts of a few texts are held at a time
            bags = [bag_of(words_of(content)) for content in texts.iloc[at:at + COUNTED]]
            different: dict[tuple[bytes, bytes], int] = {}   # equal word counts are judged once
            places = [different.setdefault((ids.tobytes(), n.tobytes()), len(different)) for ids, n in bags]
            first = {p: i for i, p in reversed(list(enumerate(places)))}
            counts = [bags[first[p]] for p in range(len(different))]
            whole = known.whole.judge(counts) if known.whole else [None] * len(counts)
            judged = []
            for words, other in zip(counts, whole):
                marks = known.counts(words)
                mark = frozenset(marks.items())
                if mark not in marked:
                    marked[mark] = known.judge(marks)
                judged.append(max(marked[mark], other, key=lambda x: x[0]) if other else marked[mark])
            out += [judged[p] for p in places]
        return pd.DataFrame(out, columns=["score", "evidence", "cosines"])

    return judge


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", toxic: str = "toxic",
             model: Model | Fitted | None = None, into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``into``: score (0 to 1), evidence (ids of the
    nearest examples) and their cosines.

    A score depends on the text alone.  Null and empty texts and texts without any
    known term get the prior.  Repeated rows are scored each; all other columns pass
    through Spark untouched; an empty table gives an empty table."""
    model = model or fit(docs, labels, key, text, toxic)
    return docs.withColumn(into, scorer(model, docs.sparkSession)(full_text(text)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= REJECT).cast("int").alias("predicted"),
                         F.col("toxicity.evidence").alias("evidence"))
