"""Operator 3: language identification with string kernels.

Texts are compared by a blended-spectrum presence kernel: the number of
distinct character 1- to 3-grams that two texts share, normalised by their own
numbers. ``landmarks`` training texts of each label span a Nyström approximation, in which a
one-versus-rest kernel ridge regression is fitted. A batch of texts becomes a
0/1 matrix over hashed n-grams; its kernel values against all landmarks are
one matrix product, its scores a second one.

The fit uses about ``per_lang`` training texts of each label, picked by a hash
of the id (a documented bound of the fit; a text over 256 KB is several
training texts, its parts). Every text is predicted whole.

Defined cases: a null text, or one without a letter, gets ``und`` with score
0; a null doc_id is carried through and never held out; repeated rows give
repeated rows; without any training label all rows get ``und``; an empty table
gives an empty result; equal scores go to the smaller label. Only doc_id and
text are read for a prediction; lang only to learn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftcheck.llm.common import drop, prepare, remainder, table

DIM = 1 << 15
PER_LANG = 250
LANDMARKS = 24  # of each label
FIT_BYTES = 1 << 18
ROWS = 128
UNKNOWN = "und"
MULTIPLIERS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


def _classes() -> np.ndarray:
    """Letters keep their code; all else in the Latin blocks becomes a space."""
    codes = np.arange(0x250, dtype=np.uint32)
    return np.where([chr(c).isalpha() for c in range(0x250)], codes, 32).astype(np.uint32)


CLASSES = _classes()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text between two spaces, by class."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    return np.where(c < 0x250, CLASSES[np.minimum(c, 0x24F)], c)


def grams(text: str, dim: int = DIM) -> np.ndarray:
    """Hashed 1-, 2- and 3-grams of the lower-cased text, repeats included."""
    c = codes(text)
    shift = np.uint32(32 - (dim.bit_length() - 1))
    one = c * MULTIPLIERS[0]
    two = (one[:-1] ^ (c[1:] * MULTIPLIERS[1])) * MULTIPLIERS[2]
    three = (two[:-1] ^ (c[2:] * MULTIPLIERS[0])) * MULTIPLIERS[1]
    return np.concatenate([one >> shift, two >> shift, three >> shift])


def presence(docs: list[str], dim: int = DIM) -> np.ndarray:
    """Rows of the 0/1 matrix, scaled to length one, so products are normalised kernel values."""
    x = np.zeros((len(docs), dim), np.float32)
    for row, text in zip(x, docs):
        row[grams(text, dim)] = 1
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return x


class Familiar:
    """Which texts fit a label: the share of their 3-grams that its training texts hold.

    The share is taken over all 3-grams with two letters or more, repeats
    included, so it does not fall with the length of a text. A label's bound comes
    from its own training texts alone, whatever the number of labels: half of them
    judged by the 3-grams of the other half, it lies three quarters of the way from
    the share of their shuffled letters to their lowest hundredth.
    """

    BITS = 18

    def __init__(self, docs: list[str], langs: list[str]):
        by_lang: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(docs, langs):
            by_lang.setdefault(lang, []).append(codes(text))
        self.known, self.bound = {}, {}
        rng = np.random.default_rng(3)
        for lang, texts in sorted(by_lang.items()):
            clean, shuffled = [], []
            for half in (0, 1):
                known = self.holds(texts[1 - half :: 2])
                for c in texts[half::2]:
                    for shares, x in ((clean, c), (shuffled, rng.permutation(c))):
                        found = known[self.threes(x)]
                        shares += [found.mean()] if len(found) else []
            chance = float(np.mean(shuffled)) if shuffled else 0.0
            least = float(np.quantile(clean, 0.01, method="lower")) if clean else 0.0
            self.known[lang], self.bound[lang] = self.holds(texts), chance + 0.75 * max(0.0, least - chance)

    @classmethod
    def threes(cls, c: np.ndarray) -> np.ndarray:
        letters = (c[:-2] != 32).astype(np.int8) + (c[1:-1] != 32) + (c[2:] != 32)
        three = (((c[:-2] ^ (c[1:-1] * MULTIPLIERS[1])) * MULTIPLIERS[2]) ^ (c[2:] * MULTIPLIERS[0])) * MULTIPLIERS[1]
        return three[letters >= 2] >> np.uint32(32 - cls.BITS)

    @classmethod
    def holds(cls, texts: list[np.ndarray]) -> np.ndarray:
        known = np.zeros(1 << cls.BITS, bool)
        for c in texts:
            known[cls.threes(c)] = True
        return known

    def fits(self, text: str, lang: str) -> bool:
        """Few 3-grams tell less, so a text may lie lower by three times the largest standard error of its share, 0.5 / sqrt(n)."""
        found = self.known[lang][self.threes(codes(text))]
        return not len(found) or bool(found.mean() >= self.bound[lang] - 1.5 / np.sqrt(len(found)))


class KernelRidge:
    """Landmark rows and the weights that turn kernel values into one score a label."""

    def __init__(self, docs: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-2, dim: int = DIM):
        self.familiar = Familiar(docs, langs)
        self.labels, y = np.unique(np.array(langs, dtype=object).astype(str), return_inverse=True)
        take = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(self.labels))])
        self.landmarks, self.dim = presence([docs[i] for i in take], dim), dim
        k = np.concatenate([presence(docs[i : i + ROWS], dim) @ self.landmarks.T for i in range(0, len(docs), ROWS)]).astype(float)
        values, vectors = np.linalg.eigh((self.landmarks @ self.landmarks.T).astype(float))
        root = vectors / np.sqrt(np.maximum(values, 1e-6))  # K^(-1/2) up to a rotation: the Nyström map
        phi = k @ root
        phi = np.c_[phi, np.ones(len(phi))]
        share = 1.0 / np.bincount(y)[y]  # each label weighs the same
        gram = phi.T @ (phi * share[:, None]) + ridge * np.diag(np.r_[np.ones(phi.shape[1] - 1), 0]) / len(self.labels)
        w = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), phi.T @ (share[:, None] * (np.arange(len(self.labels)) == y[:, None])))
        self.weights, self.bias = (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)

    def predict(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        scores = (presence(docs, self.dim) @ self.landmarks.T) @ self.weights + self.bias
        best = scores.argmax(axis=1)
        return self.labels[best], np.clip(scores[np.arange(len(docs)), best].astype(float), 0, 1)


def fit(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS, train=None) -> KernelRidge | None:
    """Fit on ``docs`` (doc_id, text, lang) where ``train`` holds; None without labels.

    Counts of each label are taken over all rows; then about ``per_lang`` texts
    of each label, chosen by a hash of the id, come to the driver. A text of
    more than ``FIT_BYTES`` counts as several: its whole is cut into parts.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where("lang is not null and text <> ''")
    rows = rows if train is None else rows.where(train)
    chars = FIT_BYTES // 4
    cuts = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / chars).cast("int")), lambda k: F.struct(k.alias("part"), F.substring(F.col("text"), k * chars + 1, F.lit(chars)).alias("text")))
    whole_text = F.array(F.struct(F.lit(0).alias("part"), F.col("text").alias("text")))
    rows = rows.select("doc_id", "lang", F.inline(F.when(F.octet_length("text") > FIT_BYTES, cuts).otherwise(whole_text)))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    whole = 1 << 30
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, min(whole, whole * per_lang // n + 1))])
    drawn = F.when(F.col("part") == 0, F.xxhash64(F.col("doc_id"), F.lit(3))).otherwise(F.xxhash64(F.col("doc_id"), F.lit(3), F.col("part")))
    picked = rows.where(F.pmod(drawn, F.lit(whole)) < share[F.col("lang")])
    sample = sorted(picked.select("doc_id", "text", "lang").limit(2 * per_lang * len(sizes)).collect(), key=lambda r: (r.lang, hash_order(r.doc_id), r.text))
    sample = [r for r in sample if has_letter(r.text)]
    return KernelRidge([r.text for r in sample], [r.lang for r in sample], landmarks) if sample else None


def hash_order(doc_id) -> int:
    """A fixed shuffle of ids, so landmarks do not follow their order."""
    return ((doc_id or 0) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


def identify(docs: DataFrame, model: KernelRidge | None, judge: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced).

    With ``judge`` also fits: whether the text is in the predicted language at all
    (see ``Familiar``); false for ``und``. The model (a fixed number of landmarks
    and labels) is broadcast.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", *(["fits"] if judge else [])]

    @F.arrow_udf("lang_pred string, score double" + (", fits boolean" if judge else ""))
    def predict(column: pa.Array) -> pa.Array:
        drop()
        model, langs, scores, fits = shared.value, [], [], []
        for lo in range(0, len(column), ROWS):
            docs = [t or "" for t in column.slice(lo, ROWS).to_pylist()]
            lang, score = np.full(len(docs), UNKNOWN, object), np.zeros(len(docs))
            real = [i for i, t in enumerate(docs) if has_letter(t)] if model else []
            if real:
                lang[real], score[real] = model.predict([docs[i] for i in real])
            langs += lang.tolist()
            scores += score.tolist()
            if judge:
                known = set(real)
                fits += [i in known and model.familiar.fits(t, lang[i]) for i, t in enumerate(docs)]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *([pa.array(fits, pa.bool_())] if judge else [])], names)

    found = docs.drop(*names).withColumn("lang_found", predict("text"))
    return found.withColumns({name: F.col(f"lang_found.{name}") for name in names}).drop("lang_found")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = fit(docs, train=~held)
    return identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
