"""Language ID by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased; every run of other characters than letters becomes one space. A model
holds, for each order, two sorted arrays of 64-bit n-gram hashes: the n-grams with their
discounted probabilities, and the contexts with the weight they give to the next shorter
context. A text's score in a language is its cross-entropy per character; the lowest wins.

Models are trained on a bounded sample of the labelled texts (:data:`SAMPLE_TEXTS` per language,
of :data:`SAMPLE_CHARS` characters together, drawn by a hash of id and text). Of a long text the sample
has :data:`TEXT_CHARS` characters from all its parts, so that a few texts never fill it. Part of the sample
is held back to calibrate: per language, how much the cross-entropy of a text in the language
varies, and, over all, how differences of cross-entropy turn into confidence.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sieveline.llm.words import chunks, mixed
from sieveline.sizing import broadcast_if_small, small_batches, staged

ORDER = 5
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 1_500_000
# Characters of one text that are learned from: fifty texts at least fit into the sample.
TEXT_CHARS = 30_000
# A long text gives so many pieces.
PIECES = 10
# One text in so many of the sample is held back for calibration.
HELD_BACK = 4
# Standard deviations above the mean cross-entropy of its language at which a text is rejected: from
# the least, as a few held-back texts do not show how far clean ones go, to the most.
LEAST_DEVIATIONS = 5.0
REJECT_DEVIATIONS = 8.0
# Quantiles, of own texts and of texts in left-out languages, between which the limit lies.
OWN_SHARE = 0.995
FOREIGN_SHARE = 0.05
# Texts of its own that weigh as much as all languages together in the spread of a language.
SPREAD_TEXTS = 100
UNDETERMINED = "und"
# Characters of a text, about, whose best language is looked at by itself before a text is rejected.
WINDOW = 100
# Characters scored together.
PIECE = 1 << 19

_letters: list[np.ndarray] = []


def is_letter(codes: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0][codes]


def codes_of(text: str) -> np.ndarray:
    """Code points of the normalised text, with a space at both ends; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = is_letter(codes)
    if not letter.any():
        return np.zeros(0, np.uint32)
    codes = np.concatenate([[np.uint32(32)], np.where(letter, codes, np.uint32(32)), [np.uint32(32)]]).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def gram_hashes(codes: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """Hashes of the 1- to ``order``-grams that end at each place; 0 where a text starts too late."""
    value = codes.astype(np.uint64) + np.uint64(1)
    out, total = [], np.zeros(len(codes), np.uint64)
    for k in range(order):
        total = total.copy()
        total[k:] += value[: max(0, len(value) - k)] * np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
        h = mixed(total)
        h[:k] = 0
        out.append(h)
    return out


def train(texts: list[np.ndarray], order: int = ORDER) -> dict:
    """Interpolated Kneser-Ney with one discount per order.

    The highest order counts occurrences; lower orders count the different characters seen
    before an n-gram. Unseen characters share the rest of the lowest order's mass.
    """
    full: list[list[np.ndarray]] = [[] for _ in range(order)]
    for codes in texts:
        for k, h in enumerate(gram_hashes(codes, order)):
            full[k].append(h)
    grams = [np.concatenate(h) for h in full]
    model: dict = {"grams": [], "contexts": []}
    for k in range(order):
        # n-grams of k + 1 characters, each with its context (all but the last character).
        here = grams[k]
        context = np.concatenate([np.concatenate([[np.uint64(0)], h[:-1]]) for h in full[k - 1]]) if k else np.zeros(len(here), np.uint64)
        ok = here != 0
        if k < order - 1:
            # Different extensions to the left: distinct longer n-grams that end alike.
            longer, first = np.unique(grams[k + 1], return_index=True)
            first = first[longer != 0]
            keys, at, count = np.unique(here[first], return_index=True, return_counts=True)
            at = first[at]
        else:
            keys, at, count = np.unique(here[ok], return_index=True, return_counts=True)
            at = np.flatnonzero(ok)[at]
        n1, n2 = (count == 1).sum(), (count == 2).sum()
        discount = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
        parents, where = np.unique(context[at], return_inverse=True)
        total = np.bincount(where, weights=count)
        kinds = np.bincount(where)
        model["grams"].append((keys, ((count - discount) / total[where]).astype(np.float64)))
        model["contexts"].append((parents, (discount * kinds / total).astype(np.float64)))
    model["unseen"] = 1.0 / (len(model["grams"][0][0]) + 1)
    return model


def looked_up(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
    names, values = table
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return np.where(names[at] == keys, values[at], missing)


def surprisal(model: dict, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
    """-log p of each n-gram's last character given the ones before."""
    p = np.full(len(grams[0]), model["unseen"])
    for k in range(len(grams)):
        # A context never seen passes all of its mass on to the shorter one.
        rest = looked_up(model["contexts"][k], contexts[k], 1.0)
        p = looked_up(model["grams"][k], grams[k], 0.0) + rest * p
    return -np.log(p)


class Scorer:
    """Total surprisal of texts in every language. Equal n-grams are looked up once per piece."""

    def __init__(self, models: list[dict], order: int = ORDER):
        self.models, self.order = models, order

    def totals(self, texts: list[np.ndarray], windows: list | None = None) -> np.ndarray:
        """(texts, languages, 2): sums of the surprisals and of their squares, the first space left out.

        ``windows`` takes pairs of arrays: windows' texts, and their sums (windows, languages).
        """
        out = np.zeros((len(texts), len(self.models), 2))
        run, size = [], 0
        for i, codes in enumerate(texts):
            # Long texts go in pieces that repeat the characters their first n-grams need.
            for at in range(0, max(len(codes), 1), PIECE):
                piece = codes[max(0, at - self.order + 1) : at + PIECE]
                run.append((i, min(at, self.order - 1) or 1, piece))
                size += len(piece)
                if size >= PIECE:
                    self.add(out, run, windows)
                    run, size = [], 0
        if run:
            self.add(out, run, windows)
        return out

    def add(self, out: np.ndarray, run: list[tuple[int, int, np.ndarray]], windows: list | None) -> None:
        run = [(i, skip, c) for i, skip, c in run if len(c) > skip]
        if not run:
            return
        parts = [gram_hashes(c, self.order) for _, _, c in run]
        grams = [np.concatenate([p[k][s:] for p, (_, s, _) in zip(parts, run)]) for k in range(self.order)]
        before = [np.concatenate([p[k][s - 1 : -1] for p, (_, s, _) in zip(parts, run)]) for k in range(self.order - 1)]
        # The longest n-gram that a place has stands for the place.
        longest = grams[0].copy()
        for k in range(1, self.order):
            longest = np.where(grams[k] != 0, grams[k], longest + np.uint64(k))
        _, at, where = np.unique(longest, return_index=True, return_inverse=True)
        g = [x[at] for x in grams]
        c = [np.zeros(len(at), np.uint64)] + [x[at] for x in before]
        bounds = np.cumsum([0] + [len(p[0]) - s for p, (_, s, _) in zip(parts, run)])
        owner = np.array([i for i, _, _ in run])
        cuts = np.maximum(np.diff(bounds) // WINDOW, 1)
        edges = np.concatenate([a + np.arange(k) * (b - a) // k for a, b, k in zip(bounds[:-1], bounds[1:], cuts)])
        inner = np.zeros((len(edges), len(self.models)))
        for m, model in enumerate(self.models):
            values = surprisal(model, g, c)[where]
            np.add.at(out[:, m, 0], owner, np.add.reduceat(values, bounds[:-1]))
            np.add.at(out[:, m, 1], owner, np.add.reduceat(values * values, bounds[:-1]))
            inner[:, m] = np.add.reduceat(values, edges)
        if windows is not None:
            windows.append((np.repeat(owner, cuts), inner))


def by_window(windows: list, n: np.ndarray, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Cross-entropy of each text with every window in its best one of the chosen languages: a text
    in two learned languages is no foreign text."""
    out = np.zeros(len(n))
    for owner, sums in windows:
        np.add.at(out, owner, sums[:, chosen].min(axis=1))
    return out / n


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def pieces_of(text: Column, h: Column, chars: int) -> Column:
    """A text of at most ``chars`` characters as it is; of a longer one, pieces from all over it with
    together so many characters: one from each tenth, where in it the hash ``h`` decides."""
    piece = max(1, chars // PIECES)
    part = F.floor(F.length(text) / PIECES).cast("int")
    start = lambda j: F.lit(j) * part + F.pmod(F.xxhash64(h, F.lit(j)), part - piece + 1).cast("int") + 1
    return F.when(F.length(text) <= chars, text).otherwise(F.concat_ws(" ", *[F.substring(text, start(j), F.lit(piece)) for j in range(PIECES)]))


def fit(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS, text_chars: int = TEXT_CHARS) -> dict:
    """Models and calibration from rows (key, lang, text): a few megabytes, bounded by the sample.

    Of each language the sample has at most ``texts`` rows with ``chars`` characters together, of each
    row at most ``text_chars`` characters, from all parts of its text. Rows are drawn by a hash of
    key, language and text, smallest first: rows that repeat a key are drawn each by its own text, rows that
    repeat all three are one, and a language with any text has its first row in the sample.
    Languages without a letter in their sample are not learned.
    """
    h = F.shiftrightunsigned(F.xxhash64("key", "lang", "text"), 11)
    rows = labelled.filter("lang is not null and text is not null").withColumn("h", h)
    # Only the smallest hashes are shuffled: of each language, about twice as many rows as are sampled.
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.min("h").alias("first"))
    share = F.lit(2.0 * texts + 100) / F.greatest(F.col("n"), F.lit(1))
    drawn = (F.col("h") <= share * float(1 << 53)) | (F.col("h") == F.col("first"))
    rows = rows.join(broadcast_if_small(sizes), "lang").filter(drawn)
    rows = rows.select("lang", "h", pieces_of(F.col("text"), F.col("h"), text_chars).alias("text"))
    # Rows that are equal are one before they leave their task.
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    rows = rows.withColumn("i", F.row_number().over(by_hash)).filter(F.col("i") <= texts)
    so_far = F.sum(F.length("text")).over(by_hash.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("chars", so_far).filter((F.col("chars") <= chars) | (F.col("i") == 1))
    sample = staged(rows.select("lang", "i", "text"), "language-sample")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        texts = [c for c in map(codes_of, pdf["text"]) if len(c)]
        if not texts:
            return pd.DataFrame({"lang": [], "model": []})
        return pd.DataFrame({"lang": pdf["lang"][:1], "model": [pickle.dumps(divided(texts))]})

    learned = sorted(sample.groupBy("lang").applyInPandas(learn, "lang string, model binary").collect())
    langs = [r["lang"] for r in learned]
    found = [pickle.loads(r["model"]) for r in learned]
    models, back = [m for m, _ in found], [b for _, b in found]
    return {"langs": langs, "models": models} | calibrated(models, back)


def divided(texts: list[np.ndarray]) -> tuple[dict, list[np.ndarray]]:
    """The model of some texts and the texts held back from it: one in :data:`HELD_BACK`, of fewer
    texts the last, of a single one its last part. Only a text of a few letters is both."""
    used, back = [c for i, c in enumerate(texts) if (i + 1) % HELD_BACK], texts[HELD_BACK - 1 :: HELD_BACK]
    if not back and len(texts) > 1:
        used, back = texts[:-1], texts[-1:]
    elif not back and len(texts[0]) >= 10 * HELD_BACK:
        at = len(texts[0]) - len(texts[0]) // HELD_BACK
        used, back = [texts[0][:at]], [texts[0][at - 1 :]]
    return train(used), back or used


def calibrated(models: list[dict], back: list[list[np.ndarray]]) -> dict:
    """Per language the mean and spread of the cross-entropy of its own texts (:func:`by_window`) and the
    deviations above the mean from which a text is rejected; the sharpness of confidence; and two
    error rates.

    A language's limit lies half-way between the high deviations of held-back texts in their own
    language and the low ones of texts that have it as best model when the model of their own
    language is left out: what an unlearned language would look like. Where both overlap, the former
    count. ``lost`` is the share of own texts that are rejected; ``passed`` lists, per left-out
    language, the share of its texts that are not.
    """
    scorer, entropies, lengths, parts, likely = Scorer(models), [], [], [], []
    mean, between, per_char = np.zeros((3, len(models)))
    for k, texts in enumerate(back):
        parts.append([])
        sums = scorer.totals(texts, parts[k])
        n = np.maximum(np.array([len(c) - 1 for c in texts]), 1)
        entropies.append(sums[:, :, 0] / n[:, None])
        lengths.append(n)
        likely.append(by_window(parts[k], n))
        mean[k] = (likely[k] * n).sum() / n.sum()
        per_char[k] = max(sums[:, k, 1].sum() / n.sum() - (sums[:, k, 0].sum() / n.sum()) ** 2, 1e-6)
        # Spread between texts beyond what their lengths explain.
        between[k] = max(float(np.mean((likely[k] - mean[k]) ** 2 - per_char[k] / n)), 0.0)
    if not models:
        return {"limits": [], "sharpness": 1.0, "lost": 0.0, "passed": []}
    # A few texts say little of the spread, so it leans on that of all languages.
    size = np.array([len(t) for t in back])
    common = (size * between / mean**2).sum() / size.sum() * mean**2
    between = (size * between + SPREAD_TEXTS * common) / (size + SPREAD_TEXTS) * (1 + 1 / size)
    deviation = lambda e, n, k: (e - mean[k]) / np.sqrt(between[k] + per_char[k] / n)
    own = [deviation(e, n, k) for k, (e, n) in enumerate(zip(likely, lengths))]
    foreign = []
    for k, (e, n) in enumerate(zip(entropies, lengths)):
        others = np.delete(np.arange(len(models)), k)
        best = others[e[:, others].argmin(axis=1)] if len(others) else np.zeros(0, int)
        foreign.append((best, deviation(by_window(parts[k], n, others), n, best) if len(others) else np.zeros(0)))
    high = max(np.quantile(np.concatenate(own), OWN_SHARE), LEAST_DEVIATIONS)
    nearest, far = (np.concatenate(x) for x in zip(*foreign))
    limits = []
    for k in range(len(models)):
        low = np.quantile(far[nearest == k], FOREIGN_SHARE) if (nearest == k).any() else np.inf
        limits.append((mean[k], between[k], per_char[k], min(max(high, (high + low) / 2), REJECT_DEVIATIONS)))
    cut = np.array([x[3] for x in limits])
    lost = float(np.mean(np.concatenate([z > cut[k] for k, z in enumerate(own)])))
    passed = [float(np.mean(z <= cut[best])) for best, z in foreign if len(z)]
    gaps = np.concatenate([e - e.min(axis=1, keepdims=True) for e in entropies])
    right = np.repeat(np.arange(len(models)), size)

    def loss(s: float) -> float:
        p = np.exp(-s * gaps)
        return float(-np.log(p[np.arange(len(right)), right] / p.sum(axis=1)).mean())

    return {"limits": limits, "sharpness": min((2.0**e for e in range(0, 9)), key=loss), "lost": lost, "passed": passed}


def identify(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred, score, entropy, rejected``.

    ``score`` is the confidence from 0 to 1: the calibrated share of the best language.
    ``entropy`` is the cross-entropy per character in it. A text is ``rejected`` when its
    cross-entropy, every window of it in its own best language, is above the limit of the language
    (see :func:`calibrated`) for a text of its length: a text of a few words has a wide one. A null text and one without letters are ``und``, with score 0, no entropy,
    and rejected; so is every text if no language was learned. Among equal languages the first by
    name wins. Columns of ``docs`` with a name of the result are replaced.
    """
    added = T.StructType(
        [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("entropy", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    names = [f.name for f in added]
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names or c == text])
    # A text that is returned as it is goes to Python once.
    same = text not in names and dict(rows.dtypes).get(text) == "string"
    value = text if same else "__text"
    if not same:
        rows = rows.withColumn(value, F.col(text).cast("string")).drop(*[c for c in names if c == text])
    back = [c for c in rows.columns if same or c != value]
    schema = T.StructType([*[f for f in rows.schema.fields if f.name in back], *added])
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, limits, sharpness = (sent.value[k] for k in ("langs", "limits", "sharpness"))
        scorer = Scorer(sent.value["models"])
        for batch in batches:
            for run in chunks(batch, value):
                texts = [codes_of(t.as_py() or "") if langs else np.zeros(0, np.uint32) for t in run.column(value)]
                n = np.maximum(np.array([len(c) - 1 for c in texts]), 1)
                known = np.array([len(c) > 0 for c in texts])
                windows = []
                entropy = scorer.totals(texts, windows)[:, :, 0] / n[:, None] if langs else np.zeros((len(texts), 1))
                best = entropy.argmin(axis=1)
                least = entropy[np.arange(len(texts)), best]
                share = 1.0 / np.exp(-sharpness * (entropy - least[:, None])).sum(axis=1)
                mean, between, per_char, deviations = np.array(limits or [(0, 0, 0, 0)]).T[:, best]
                limit = mean + deviations * np.sqrt(between + per_char / n)
                columns = [run.column(c) for c in back]
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array([langs[b] if k else UNDETERMINED for b, k in zip(best, known)], pa.string()),
                        pa.array(np.where(known, share, 0.0)),
                        pa.array(least, mask=~known),
                        pa.array(~known | (by_window(windows, n) > limit)),
                    ],
                    schema=pa.schema([*[run.schema.field(c) for c in back], ("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_())]),
                )

    return rows.mapInArrow(predict, schema)


def fit_on(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", **bounds: int) -> dict:
    """A model from the labelled documents that are not held out; rows without an id are not used.

    ``bounds`` are those of :func:`fit`.
    """
    labelled = docs.filter(F.col(doc_id).isNotNull() & ~held_out(doc_id))
    return fit(labelled.select(F.col(doc_id).cast("string").alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")), **bounds)
