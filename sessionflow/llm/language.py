"""Language identification as inference over mixtures of languages.

Each language has probabilities of hashed byte 4-grams, learnt from labelled texts. A text's proportions of languages
maximise the likelihood of its n-grams, by expectation-maximisation over all texts of a chunk at once. Which languages a
text holds is then chosen step by step: the next language joins while the likelihood grows by more than a penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionflow.llm.frames import batch
from sessionflow.llm.set_join import ddl
from sessionflow.llm.words import chunks

UNKNOWN = "und"
#: Bound on the fit: labelled texts per language, chosen by a hash of doc_id; all others of the table are only predicted.
FIT_ROWS = 3000
FEATURE_BITS, GRAM = 16, 4
ROUNDS, SMOOTHING = 8, 0.1
#: Price of one more language in units of log(number of n-grams); n-grams overlap, so it is well above one half.
PENALTY = 4.0
#: A language found in a text, and its share.
FOUND = pa.struct([("lang", pa.string()), ("share", pa.float64())])
COUNTS = pa.schema([("lang", pa.string()), ("counts", pa.binary())])

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, count) of the distinct 4-grams of letters in each row, in row order; blanks only at their ends."""
    folded = _FOLD[data]
    if len(folded) < GRAM:
        return (np.zeros(0, np.int64),) * 3
    at = [folded[i : len(folded) - GRAM + 1 + i] for i in range(GRAM)]
    ok = (at[1] != 32) & (at[2] != 32)
    row = np.searchsorted(offsets, start := np.flatnonzero(ok), "right") - 1
    inside = start + GRAM <= offsets[row + 1]
    start, row = start[inside], row[inside]
    code = sum(at[i][start].astype(np.uint32) << np.uint32(8 * i) for i in range(GRAM))
    feature = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)
    key, count = np.unique(row.astype(np.int64) << FEATURE_BITS | feature, return_counts=True)
    return key >> FEATURE_BITS, key & ((1 << FEATURE_BITS) - 1), count


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        for first, data, offsets in chunks(b.column("text")):
            row, feature, count = grams(data, offsets)
            of = langs[first + row]
            for lang in set(of.tolist()):
                mine = of == lang
                totals.setdefault(lang, np.zeros(1 << FEATURE_BITS))
                totals[lang] += np.bincount(feature[mine], count[mine], 1 << FEATURE_BITS)
    if totals:
        yield batch(COUNTS, lang=list(totals), counts=[t.tobytes() for t in totals.values()])


def _sum_counts(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << FEATURE_BITS)
    for b in batches:
        for part in b.column("counts"):
            total += np.frombuffer(part.as_buffer())
    yield batch(COUNTS, lang=[key[0].as_py()], counts=[total.tobytes()])


def fit(labelled: DataFrame, rows_per_language: int = FIT_ROWS) -> tuple[list[str], np.ndarray]:
    """The languages of ``labelled`` (doc_id, text, lang) and the log-probability of each feature, least frequent
    language last. At most about ``rows_per_language`` texts of a language are read, whole; rows with null text or
    language teach nothing."""
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = sorted(labelled.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r.lang))  # a row per language
    if not sizes:
        return [], np.zeros((0, 1 << FEATURE_BITS))
    share = F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, rows_per_language / r["count"])))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(draw < F.element_at(share, F.col("lang"))).select("text", "lang")
    summed = sample.mapInArrow(_language_counts, ddl(COUNTS)).groupBy("lang").applyInArrow(_sum_counts, ddl(COUNTS))
    counts = {lang: np.frombuffer(c) for lang, c in summed.collect()}  # 2^16 numbers per language
    langs = [r.lang for r in sizes if r.lang in counts]
    table = np.stack([counts[lang] for lang in langs]) + SMOOTHING
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def _mixture(prob: np.ndarray, count: np.ndarray, starts: np.ndarray, row: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts x languages) after some rounds from ``begin``, and the log-likelihoods."""
    share = begin
    total = np.add.reduceat(count, starts).astype(float)
    for _ in range(ROUNDS):
        weight = share[row] * prob
        weight *= (count / weight.sum(axis=1))[:, None]
        share = np.add.reduceat(weight, starts, axis=0) / total[:, None]
    return share, np.add.reduceat(np.log((share[row] * prob).sum(axis=1)) * count, starts)


def proportions(logs: np.ndarray, row: np.ndarray, feature: np.ndarray, count: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the proportions of the languages chosen for it (zero for others), and the probability of each language if
    the text were in one alone. Rows without n-grams give zeros."""
    chosen, alone = np.zeros((n_rows, len(logs))), np.zeros((n_rows, len(logs)))
    if not len(row):
        return chosen, alone
    present, starts = np.unique(row, return_index=True)
    place = np.searchsorted(present, row)
    log = logs.T[feature]
    single = np.add.reduceat(log * count[:, None], starts, axis=0)
    alone[present] = np.exp(single - single.max(axis=1, keepdims=True))
    alone[present] /= alone[present].sum(axis=1, keepdims=True)
    prob = np.exp(log)
    full, _ = _mixture(prob, count, starts, place, np.full((len(present), len(logs)), 1 / len(logs)))
    top = single.argmax(axis=1)
    every = np.arange(len(present))
    member = np.zeros(full.shape, bool)
    member[every, top] = True
    share, likelihood = member.astype(float), single[every, top]
    price = PENALTY * np.log(np.add.reduceat(count, starts) + 1.0)
    active = every
    while len(active) and member.shape[1] > 1:
        left = np.where(member[active], -1.0, full[active])
        following = left.argmax(axis=1)
        active, following = active[left.max(axis=1) > 1e-3], following[left.max(axis=1) > 1e-3]
        if not len(active):
            break
        trial = member[active]
        trial[np.arange(len(active)), following] = True
        mine = np.isin(place, active)
        sub = np.searchsorted(active, place[mine])
        begin = np.where(trial, np.maximum(full[active], 1e-3), 0)
        begin /= begin.sum(axis=1, keepdims=True)
        first = np.flatnonzero(np.concatenate([[True], sub[1:] != sub[:-1]]))
        found, reached = _mixture(prob[mine], count[mine], first, sub, begin)
        better = reached - likelihood[active] > price[active]
        active = active[better]
        member[active], share[active], likelihood[active] = trial[better], found[better], reached[better]
    chosen[present] = share
    return chosen, alone


def _predict(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = model.value
        for b in batches:
            for first, data, offsets in chunks(b.column("text")):
                n = len(offsets) - 1
                share, alone = proportions(logs, *grams(data, offsets), n) if langs else (np.zeros((n, 1)),) * 2
                best = share.argmax(axis=1)
                each = np.arange(n)
                one = (share > 0).sum(axis=1) == 1
                score = np.where(one, alone[each, best], share[each, best])
                known = b.column("letters").slice(first, n).to_numpy(zero_copy_only=False) & bool(langs)
                # letters, but too few for an n-gram: the most frequent language, without confidence
                names = [langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
                rows = b.slice(first, n)
                share = np.where(known[:, None], share, 0.0)
                at = np.concatenate([[0], np.cumsum((share > 0).sum(axis=1))])
                row, which = np.nonzero(share)
                order = np.lexsort((which, -share[row, which], row))
                row, which = row[order], which[order]
                found = pa.StructArray.from_arrays([pa.array([langs[k] for k in which.tolist()], pa.string()), pa.array(share[row, which])], fields=list(FOUND))
                columns = [rows.column("row"), rows.column("text"), rows.column("held_out"), pa.array(names, pa.string()), pa.array(np.clip(np.where(known, score, 0.0), 0, 1)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), found)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "held_out", "lang_pred", "score", "languages"])

    return run


def with_languages(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(row, text, held_out, lang_pred, score, languages) per row of ``docs``; row holds its columns other than text.

    Learns from the rows of ``labelled`` (doc_id, text, lang; default: ``docs``) that are not held out, by crc32 of doc_id,
    and predicts from the text alone. languages lists the languages chosen for the text with their shares, largest first.
    lang_pred is the first of them; score is its share, or its probability where it is the only one. Null text or text
    without a letter: ``und`` with score 0 and no languages, as are all rows where no language can be learnt. A null doc_id is
    not held out. Repeated rows are predicted each; other columns are carried along.
    """
    source = docs if labelled is None else labelled
    langs, logs = fit(source.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    model = docs.sparkSession.sparkContext.broadcast((langs, logs))  # 2^16 numbers per language
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    row = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(row, "text", held_out(F.col("doc_id")).alias("held_out"), letters.alias("letters"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, text string, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    return rows.mapInArrow(_predict(model), schema)


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) per row of ``docs``, as ``with_languages`` has them."""
    found = with_languages(docs.select("doc_id", "text"), docs if labelled is None else labelled)
    return found.select("row.doc_id", "held_out", "lang_pred", "score", "languages")
