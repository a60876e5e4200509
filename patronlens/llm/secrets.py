"""Secret scan whose false positives a random forest removes.

Candidates are unbroken runs of 16 or more token signs, dots between them included, values of 6 or more
signs of any kind that are assigned to a credential word, and the passwords of addresses with a user.
The forest sees a candidate's length and make-up, how likely its characters follow each other in the corpus,
how much of it dictionary words cover, where it was found and the words around it, hashed. It
is trained from labelled findings. Dictionary and transitions are counted over all
documents.

Where no reviewed findings are given, the clear cases label themselves by how they are written down: a value
assigned to a credential word, in quotes or right after an equals sign, is a secret, a run with neither an assignment nor a credential word
near it is none. What these labels rest on is then kept from the forest, so that it learns what secrets
look like and decides the other cases, and even labelled ones, by that.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronlens.llm.common import text_bytes
from patronlens.session import materialize

#: Least signs of a run, and of a value assigned to a credential word.
LEAST_RUN, LEAST_VALUE = 16, 6
RUN = re.compile(r"[A-Za-z0-9+/_=\-]+(?:\.[A-Za-z0-9+/_=\-]+)*")
#: Signs before and after a candidate in which neighbours are looked for.
AROUND = 48
# Words that tell of a credential, and of a path that holds no live secrets.
CREDENTIAL = re.compile(r"token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|auth|bearer|credential", re.I)
HARMLESS_PATH = re.compile(r"test|example|sample|mock|fixture|vendor|docs?\b", re.I)
VALUE = re.compile(
    r"(?:token|secret|passwd|password|passphrase|pwd|api[_\- ]?key|access[_\- ]?key|private[_\- ]?key|credentials?|auth)"
    r"[\w\-]{0,24}[\"']?[ \t]{0,4}(?::=|=>|=|:)[ \t]{0,4}(?:\"(?P<double>[^\"\n]{6,})\"|'(?P<single>[^'\n]{6,})'|(?P<bare>[^\s\"',;]{6,}))",
    re.I,
)
ADDRESS = re.compile(r"://[^\s/:@]{0,64}:(?P<value>[^\s/@]{6,})@")
#: Neighbouring words are counted in so many hashed places on either side.
PLACES = 16
CONTENT = (
    "length", "digits", "upper", "lower", "signs", "entropy", "class_changes", "transition", "worst_transition",
    "covered", "hexadecimal", "harmless_path", "path_like", "words_before",
    *[f"before_{n}" for n in range(PLACES)], *[f"after_{n}" for n in range(PLACES)],
)
#: How a candidate is written down. Self-made labels rest on these.
WRITTEN = ("assigned", "quoted", "tight", "address", "credential_near")
FEATURES = (*CONTENT, *WRITTEN)
_WORD = re.compile(r"[a-z]{4,12}")
_NEIGHBOUR = re.compile(r"[^\W\d_]{2,}")


@dataclass(frozen=True)
class Language:
    """What the corpus looks like: log-probabilities of character pairs and frequent words."""

    pairs: dict[str, float] = field(default_factory=dict)
    words: frozenset[str] = frozenset()
    floor: float = -12.0

    def transitions(self, text: str) -> list[float]:
        return [self.pairs.get(a + b, self.floor) for a, b in zip(text, text[1:], strict=False)]

    def covered(self, text: str) -> float:
        """Share of ``text`` that words of the dictionary cover, longest word first at each place."""
        low, at, total = text.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(12, len(low) - at), 3, -1) if low[at : at + n] in self.words), 0)
            total += size
            at += size or 1
        return total / len(low)


def count_language(docs: DataFrame, max_words: int = 20_000, text_col: str = "text") -> Language:
    """Character pairs and the ``max_words`` most frequent words (4 to 12 letters) of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, pairs = Counter(), np.zeros(1 << 14, np.int64)
            for text in text_bytes(batch.column(0)):
                if text:
                    words.update(_WORD.findall(text.decode().lower()))
                    signs = np.frombuffer(text, np.uint8).astype(np.int64)
                    both = (signs[:-1] < 128) & (signs[1:] < 128)
                    pairs += np.bincount((signs[:-1] << 7 | signs[1:] & 127)[both], minlength=1 << 14)
            seen = np.flatnonzero(pairs)
            keys = [*words, *[chr(p >> 7) + chr(p & 127) for p in seen.tolist()]]
            counts = [*words.values(), *pairs[seen].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(counts, pa.int64())], ["key", "n"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "key string, n bigint")
    counted = materialize(counted.groupBy("key").agg(F.sum("n").alias("n")))
    # Both sides are bounded: pairs of 128 signs, and max_words words.
    pairs = {r["key"]: r["n"] for r in counted.filter(F.length("key") == 2).collect()}
    words = counted.filter(F.length("key") > 2).orderBy(F.desc("n"), "key").limit(max_words).select("key").collect()
    first = Counter()
    for key, n in pairs.items():
        first[key[0]] += n
    table = {key: math.log(n / first[key[0]]) for key, n in pairs.items()}
    return Language(table, frozenset(r["key"] for r in words))


def candidates_of(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, start of the assignment, way) of each candidate.

    Ways are quoted, tight (right after an equals sign), bare, address and run.
    A run that overlaps a value is not reported again.
    """
    found = []
    for hit in VALUE.finditer(text):
        start, end = hit.span(hit.lastgroup)
        way = "quoted" if hit.lastgroup != "bare" else "tight" if text[start - 1] == "=" else "bare"
        found.append((start, end, hit.start(), way))
    found += [(*hit.span("value"), hit.start(), "address") for hit in ADDRESS.finditer(text)]
    found.sort()
    kept: list[tuple[int, int, int, str]] = []
    for one in found:
        if not kept or one[0] >= kept[-1][1]:
            kept.append(one)
    starts = [k[0] for k in kept]
    for hit in RUN.finditer(text):
        start, end = hit.span()
        if end - start >= LEAST_RUN:
            n = bisect.bisect_left(starts, end)
            if not n or kept[n - 1][1] <= start:
                kept.append((start, end, start, "run"))
                continue
    return sorted(kept)


def _hashed(words: list[str]) -> list[float]:
    out = [0.0] * PLACES
    for word in words:
        out[zlib.crc32(word.lower().encode()) % PLACES] += 1.0
    return out


def features(text: str, start: int, end: int, key: int, way: str, path: str, language: Language) -> list[float]:
    """The numbers of ``FEATURES`` for one candidate. ``key`` is where its assignment begins.

    Neighbouring words leave out the assignment itself and, so that a run is seen alike, the word before a run.
    """
    token = text[start:end]
    before, after = text[max(0, key - AROUND) : key], text[end : end + AROUND]
    n = len(token)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in token]
    share = Counter(kinds)
    steps = language.transitions(token)
    words_before = _NEIGHBOUR.findall(before)
    if way == "run":
        words_before = words_before[:-1]
    return [
        float(n),
        share["d"] / n,
        share["u"] / n,
        share["l"] / n,
        share["s"] / n,
        -sum(c / n * math.log2(c / n) for c in Counter(token).values()),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        sum(steps) / len(steps),
        min(steps),
        language.covered(token),
        float(all(c in "0123456789abcdefABCDEF" for c in token)),
        float(bool(HARMLESS_PATH.search(path))),
        float(token.count("/") >= 2),
        float(len(words_before)),
        *_hashed(words_before),
        *_hashed(_NEIGHBOUR.findall(after)),
        float(way in ("quoted", "tight", "bare")),
        float(way == "quoted"),
        float(way == "tight"),
        float(way == "address"),
        float(bool(CREDENTIAL.search(text[max(0, start - AROUND) : start]) or CREDENTIAL.search(after))),
    ]


def find_candidates(
    docs: DataFrame, language: Language, path_col: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, start, length, sha256, x): every candidate of every text with its features; the secret itself is not kept.

    Runs have 16 signs at least, values after a credential word and in addresses 6. Null and empty texts have none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, start, length, digest, x = [], [], [], [], []
            paths = batch.column(2).to_pylist()
            for row, raw in enumerate(text_bytes(batch.column(1))):
                text = (raw or b"").decode()
                for a, b, key, way in candidates_of(text):
                    owner.append(row)
                    start.append(a)
                    length.append(b - a)
                    digest.append(hashlib.sha256(text[a:b].encode()).hexdigest())
                    x.append(features(text, a, b, key, way, paths[row], language))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(x, pa.list_(pa.float64())),
                ],
                [id_col, "start", "length", "sha256", "x"],
            )

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"), path.alias("_path"))
    return rows.mapInArrow(find, f"`{id_col}` {kind}, start bigint, length bigint, sha256 string, x array<double>")


def distant_labels(candidates: DataFrame) -> DataFrame:
    """``candidates`` with a ``label`` where the way of writing decides: 1 secret, 0 not, null open."""
    at = {name: F.get("x", F.lit(i)) for i, name in enumerate(FEATURES)}
    secret = ((at["quoted"] == 1) | (at["tight"] == 1)) & (at["harmless_path"] == 0)
    plain = (at["assigned"] == 0) & (at["address"] == 0) & (at["credential_near"] == 0)
    return candidates.withColumn("label", F.when(secret, 1.0).when(plain, 0.0))


def inputs_of(names: tuple[str, ...]) -> Column:
    """The named features as a vector."""
    return array_to_vector(F.array(*[F.get("x", F.lit(FEATURES.index(n))) for n in names]))


def fit_forest(
    findings: DataFrame, max_rows: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 5, names: tuple[str, ...] = FEATURES
) -> RandomForestClassificationModel | None:
    """Forest over the ``names`` of labelled findings (x, label, sha256, start); None if a class is missing.

    ``max_rows`` bounds the sample, half for each class, of the lowest hashes, chosen partition by
    partition; the sample is one sorted partition, so a fit repeats exactly.
    """
    known = findings.filter(F.col("label").isin(0.0, 1.0)).select("x", "label", F.xxhash64("sha256", "start", F.lit(seed)).alias("_hash"))
    classes = [known.filter(F.col("label") == c).orderBy("_hash", "x").limit(max_rows // 2) for c in (0.0, 1.0)]
    chosen = classes[0].unionByName(classes[1])
    sample = materialize(chosen.coalesce(1).sortWithinPartitions("label", "_hash", "x").select(inputs_of(names).alias("x"), "label"))
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, minInstancesPerNode=2
    )
    return forest.fit(sample)


def score_candidates(candidates: DataFrame, model: RandomForestClassificationModel, names: tuple[str, ...] = FEATURES) -> DataFrame:
    """``candidates`` with ``score``, the probability of a secret."""
    scored = model.transform(candidates.withColumn("_inputs", inputs_of(names)).drop("x").withColumnRenamed("_inputs", "x"))
    return scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).drop("x", "rawPrediction", "probability", "prediction")


def measure(candidates: DataFrame, threshold: float = 0.5, max_rows: int = 20_000, folds: int = 5, id_col: str = "doc_id") -> DataFrame:
    """(label, kept, findings) on held-out findings: the forest is fitted on the labelled ``candidates`` of the other documents.

    The documents whose id hashes to 0 of ``folds`` are held out. No rows come out if a class is missing.
    """
    fold = F.pmod(F.xxhash64(id_col), F.lit(folds))
    model = fit_forest(candidates.filter(fold != 0), max_rows, names=CONTENT)
    held = candidates.filter((fold == 0) & F.col("label").isNotNull())
    if model is None:
        return held.limit(0).select("label", F.lit(False).alias("kept"), F.lit(0).cast("bigint").alias("findings"))
    scored = score_candidates(held, model, CONTENT)
    return scored.groupBy("label", (F.col("score") >= threshold).alias("kept")).agg(F.count(F.lit(1)).alias("findings"))


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    threshold: float = 0.5,
    max_rows: int = 20_000,
    path_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, start, length, sha256, score): the candidates that the forest takes for secrets.

    ``findings`` are labelled candidates (x, label, sha256, start) to train from, whose every feature then
    counts; without them the clear cases label themselves and the forest sees ``CONTENT`` alone. If only one class is
    known there is no forest: candidates that the way of writing labels 0 go, the others stay with score 1. Null and empty texts have no
    candidate; repeated rows report each their own, and equal findings have equal scores if their surroundings are equal.
    """
    language = count_language(docs, text_col=text_col)
    candidates = materialize(find_candidates(docs, language, path_col, id_col, text_col))
    names = CONTENT if findings is None else FEATURES
    model = fit_forest(distant_labels(candidates) if findings is None else findings, max_rows, names=names)
    if model is None:
        return distant_labels(candidates).filter("coalesce(label, 1) = 1").drop("x", "label").withColumn("score", F.lit(1.0))
    return score_candidates(candidates, model, names).filter(F.col("score") >= threshold).select(id_col, "start", "length", "sha256", "score")
