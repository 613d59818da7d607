"""Operators on documents against brute force, on the small table and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, no_documents, odd_documents, words
from conftest import SF_DIR

import corpus_pipeline
from sessionflow.llm import line_dedup, ngram_join, suffix_dedup
from sessionflow.llm.language import identify
from sessionflow.llm.line_dedup import dedup_lines
from sessionflow.llm.ngram_join import near_duplicates, representatives
from sessionflow.llm.suffix_dedup import dedup_passages, merge_runs

TABLES = {"small": lambda spark: documents(spark, SF_DIR), "odd": odd_documents, "empty": no_documents}


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def roots(sets, linked):
    """Union-find over all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def jaccard(x, y, num, den):
    both = len(x & y)
    return bool(x) and bool(y) and den * both >= num * (len(x) + len(y) - both)


def expected_components(rows):
    with_id = [(i, shingles(t)) for i, t in rows if i is not None]
    found = roots([s for _, s in with_id], lambda x, y: jaccard(x, y, 3, 4))
    least = defaultdict(lambda: float("inf"))
    for (i, _), r in zip(with_id, found, strict=True):
        least[r] = min(least[r], i)
    out = [(i, len(s), least[r]) for (i, s), r in zip(with_id, found, strict=True)]
    return Counter(out + [(None, len(shingles(t)), None) for i, t in rows if i is None])


@pytest.mark.parametrize("table", TABLES)
def test_near_duplicates_equal_brute_force(spark, table):
    df = TABLES[table](spark)
    assert Counter(map(tuple, near_duplicates(df).collect())) == expected_components(rows_of(df))


def test_large_groups_of_near_copies(spark):
    """Many near copies that share all rare shingles, a chain of links, and a passage common to unlike texts."""
    base = words(5, 120).split()
    rows = []
    for i in range(150):
        changed = list(base)
        changed[i % 120] = f"w{i}"
        rows.append((i, " ".join(changed)))
    chain = words(6, 100).split()
    for i in range(12):  # each is like the next, the ends are not alike
        rows.append((1000 + i, " ".join(chain[4 * i : 4 * i + 56])))
    shared = words(7, 20)
    rows += [(2000 + i, words(100 + i, 60) + " " + shared) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, near_duplicates(df).collect())) == expected_components(rows)


def test_near_copies_that_are_not_all_alike_meet_few_others(spark, monkeypatch):
    """A group whose members are alike by way of others: neither its entries nor its pairs grow with its square."""
    base, draw, rows = words(8, 400).split(), random.Random(9), []
    for i in range(160):
        changed = list(base)
        for at in draw.sample(range(400), draw.randint(2, 8)):
            changed[at] = f"w{i}-{at}"
        rows.append((i, " ".join(changed)))
    tried, entries = [], []
    verify, with_leader = ngram_join.verify, ngram_join.pairs_with_leader
    monkeypatch.setattr(ngram_join, "verify", lambda pairs, *rest: tried.append(pairs.count()) or verify(pairs, *rest))
    monkeypatch.setattr(ngram_join, "pairs_with_leader", lambda found, *rest: entries.append(found.select("token").distinct().count()) or with_leader(found, *rest))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, near_duplicates(df).collect())) == expected_components(rows)
    assert sum(tried) < 10 * len(rows)
    two = [(0, " ".join(base)), (1, " ".join([*base[:399], "other"]))]  # all shingles that both have are one entry each
    assert Counter(map(tuple, near_duplicates(spark.createDataFrame(two, df.schema)).collect())) == expected_components(two)
    assert entries[-1] == 1


def test_hubs_that_link_little_are_not_tried_again(spark, monkeypatch):
    """Unlike texts put together from the same passages: all shingles are common, and no hub brings any together."""
    passages, draw = [words(300 + i, 30) for i in range(16)], random.Random(3)
    rows = [(i, f" alone{i} ".join(draw.sample(passages, 4))) for i in range(300)]
    rows.append((300, rows[7][1] + " other"))
    rounds, with_hubs = [], ngram_join.pairs_with_hubs
    monkeypatch.setattr(ngram_join, "pairs_with_hubs", lambda *args: rounds.append(args[0].count()) or with_hubs(*args))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, near_duplicates(df).collect())) == expected_components(rows)
    assert len(rounds) == 1 and rounds[0] > 0


def test_one_document_of_each_group_stays(spark):
    df = odd_documents(spark)
    kept = representatives(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {0, 1, 2, 3, 4, 5, 9, 11} <= set(ids) and not {6, 8, 10} & set(ids)


def expected_lines(rows):
    """Lines that go and what is left, by comparing each line with all earlier ones."""
    lines = sorted((i, j, frozenset(p.encode().lower().split())) for i, t in rows if i is not None for j, p in enumerate((t or "").split("\n")) if t)
    lines = [x for x in lines if len(x[2]) >= line_dedup.MIN_WORDS]
    going = {(i, j, w) for k, (i, j, w) in enumerate(lines) if any((i, j) > (a, b) and jaccard(w, v, 9, 10) for a, b, v in lines[:k])}
    out = []
    for i, t in rows:
        parts = t.split("\n") if t else []
        left = [p for j, p in enumerate(parts) if (i, j, frozenset(p.encode().lower().split())) not in going]
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest() if len(left) < len(parts) else hashlib.sha256((t or "").encode()).hexdigest()
        out.append((i, len(parts), len(parts) - len(left), digest))
    return Counter(out)


@pytest.mark.parametrize("frequent", [128, 2])
@pytest.mark.parametrize("table", TABLES)
def test_line_dedup_equals_brute_force(spark, table, frequent, monkeypatch):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    df = TABLES[table](spark)
    found = dedup_lines(df).select("row.doc_id", "n_lines", "n_removed", "sha256")
    assert Counter(map(tuple, found.collect())) == expected_lines(rows_of(df))


def test_common_lines_and_their_variants(spark):
    line = words(8, 30).split()
    rows = [(i, words(300 + i, 12) + "\n" + " ".join(line[:k] + [f"v{i}"] + line[k + 1 :])) for i, k in enumerate([3, 7, 7, 11, 20, 25] * 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dedup_lines(df).select("row.doc_id", "n_lines", "n_removed", "sha256")
    assert Counter(map(tuple, found.collect())) == expected_lines(rows)


def test_short_lines_and_lines_without_blanks(spark):
    """Any line with a word goes when its set of words came before, whatever its length; wordless lines stay."""
    east = "这是一行没有空格的很长的中文文本它会在很多文档里重复出现"
    texts = ["Menu\n\nread more\nhome about contact us\n" + east, "menu\nmore  READ\n\n  \nhome about contact you", east + "\nสวัสดีชาวโลก\nmenu", "สวัสดีชาวโลก\n" + east + "一", "one two three four five six seven eight nine\nmenu\nmenu", "one two three four five six seven eight nine ten"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    left = {r.doc_id: r.text.split("\n") for r in dedup_lines(df).select("row.doc_id", "text").collect()}
    assert left == {
        0: ["Menu", "", "read more", "home about contact us", east],
        1: ["", "  ", "home about contact you"],
        2: ["สวัสดีชาวโลก"],
        3: [east + "一"],
        4: ["one two three four five six seven eight nine"],
        5: [""],
    }


@pytest.mark.parametrize("num,den", [(9, 10), (3, 4), (4, 5), (1, 2), (1, 1)])
def test_least_size_with_other_similar_sets(num, den):
    similarity = line_dedup.Similarity(num, den)
    others = [n for n in range(1, 40) if den * n >= num * (n + 1)]  # a set of n words and one with a word more
    assert similarity.least_with_others == min(others, default=1)


def expected_passages(rows, length):
    first = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, raw in raws:
        for s in range(len(raw) - length + 1) if i is not None else ():
            w = raw[s : s + length]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - length + 1) if i is not None else ():
            if first[raw[s : s + length]] < (i, s):
                gone[s : s + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("table,length", [("small", 100), ("odd", 100), ("odd", 20), ("empty", 100)])
def test_passages_equal_brute_force(spark, table, length):
    df = TABLES[table](spark)
    found = dedup_passages(df, length).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == expected_passages(rows_of(df), length)


def test_passages_across_borders_and_runs(spark, monkeypatch):
    """Two letters only: windows repeat everywhere, many ranges cut through them, and runs are short."""
    for name, value in (("RUN_SUFFIXES", 50), ("FLUSH_POINTS", 64), ("RANGE_SUFFIXES", 40), ("BUCKET_POINTS", 64)):
        monkeypatch.setattr(suffix_dedup, name, value)
    draw = random.Random(4)
    pieces = ["".join(draw.choice("ab\0é") for _ in range(40)) for _ in range(6)]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(12))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = dedup_passages(df, 24).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, found.collect())) == expected_passages(rows, 24)


def test_loser_tree_gives_order_and_common_prefixes():
    draw = random.Random(1)
    agree = lambda x, y: next((i for i in range(8) if x[i] != y[i]), 8)
    for _ in range(200):
        runs = [sorted(bytes(draw.choice(b"ab") for _ in range(8)) for _ in range(draw.randint(0, 12))) for _ in range(draw.randint(1, 9))]
        commons = [[0, *(agree(a, b) for a, b in zip(r, r[1:], strict=False))] for r in runs]
        order, common = merge_runs(runs, commons, 8)
        merged = [runs[r][i] for r, i in order]
        assert merged == sorted(x for r in runs for x in r)
        assert common[1:] == [agree(a, b) for a, b in zip(merged, merged[1:], strict=False)]


def test_language_held_out_accuracy(spark):
    df = documents(spark, "/root/testdata/sf0.01")
    found = identify(df).join(df.select("doc_id", "lang"), "doc_id").filter("held_out AND lang_pred != 'und'").collect()
    assert len(found) > 200
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.98


def test_language_of_odd_rows(spark):
    df = odd_documents(spark)
    found = {(r.doc_id, r.lang_pred) for r in identify(df).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (3, "en")} <= found
    assert all(0 <= r.score <= 1 for r in identify(df).collect())
    unlabelled = identify(df.drop("lang").selectExpr("*", "cast(null as string) AS lang")).collect()
    assert len(unlabelled) == df.count() and {r.lang_pred for r in unlabelled} == {"und"}
    assert identify(no_documents(spark)).collect() == []


def test_mixture_of_two_languages():
    import pyarrow as pa

    from sessionflow.llm.language import grams, proportions
    from sessionflow.llm.words import buffers

    texts = [words(9, 400), words(10, 400).translate(str.maketrans("abcdefghij", "klmnopqrst"))]
    counts = np.full((2, 1 << 16), 0.1)
    for k, t in enumerate(texts):
        _, feature, count = grams(*buffers(pa.array([t])))
        np.add.at(counts[k], feature, count)
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    half = " ".join(texts[0].split()[:150] + texts[1].split()[:50])
    share, _ = proportions(logs, *grams(*buffers(pa.array([texts[0], half]))), 2)
    assert share[0].tolist() == [1.0, 0.0]
    assert abs(share[1, 0] - 0.75) < 0.05


def plain_em(prob, count, begin, rounds):
    """Expectation-maximisation for one text, n-gram by n-gram."""
    share = list(begin)
    for _ in range(rounds):
        new = [0.0] * len(share)
        for p, c in zip(prob, count, strict=True):
            whole = sum(s * x for s, x in zip(share, p, strict=True))
            for k, (s, x) in enumerate(zip(share, p, strict=True)):
                new[k] += c * s * x / whole
        share = [x / sum(count) for x in new]
    return share, sum(c * np.log(sum(s * x for s, x in zip(share, p, strict=True))) for p, c in zip(prob, count, strict=True))


def test_mixtures_equal_plain_expectation_maximisation():
    """Proportions, likelihoods and the penalised choice of languages for random texts over three languages."""
    from sessionflow.llm import language

    draw = np.random.default_rng(4)
    logs = np.log(draw.dirichlet(np.full(40, 0.3), 3))
    texts = [draw.choice(40, n, p=np.exp(logs[draw.integers(3)]) if n % 2 else np.exp(logs).mean(axis=0)) for n in (1, 2, 7, 30, 81, 300, 301)]
    parts = [np.unique(t, return_counts=True) for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(f) for f, _ in parts])
    feature, count = (np.concatenate(c) for c in zip(*parts, strict=True))
    chosen, alone = language.proportions(logs, row, feature, count, len(texts))
    for i, (f, c) in enumerate(parts):
        prob = np.exp(logs.T[f])
        single = [float((np.log(prob[:, k]) * c).sum()) for k in range(3)]
        full, _ = plain_em(prob, c, [1 / 3] * 3, language.ROUNDS)
        langs, share, best = [int(np.argmax(single))], [1.0], max(single)
        while True:
            left = [k for k in np.argsort([-x for x in full], kind="stable") if k not in langs and full[k] > 1e-3]
            if not left:
                break
            trial = [*langs, int(left[0])]
            begin = np.maximum([full[k] for k in trial], 1e-3)
            found, reached = plain_em(prob[:, trial], c, begin / begin.sum(), language.ROUNDS)
            if reached - best <= language.PENALTY * np.log(c.sum() + 1.0):
                break
            langs, share, best = trial, found, reached
        want = np.zeros(3)
        want[langs] = share
        assert np.allclose(chosen[i], want, atol=1e-9)
        assert np.allclose(alone[i], np.exp(np.array(single) - max(single)) / np.exp(np.array(single) - max(single)).sum())


def test_languages_come_with_their_shares(spark):
    df = documents(spark, "/root/testdata/sf0.01").filter("doc_id < 400")
    by_lang = {r.lang: r.text for r in df.filter("lang IS NOT NULL AND length(text) > 2000").collect()}
    first, second = sorted(by_lang)[:2]
    both = spark.createDataFrame([(-1, by_lang[first][:2000] + " " + by_lang[second][:1000]), (-2, by_lang[first])], "doc_id bigint, text string")
    found = {r.doc_id: r for r in identify(both, df).collect()}
    assert [x.lang for x in found[-1].languages] == [first, second] and found[-1].lang_pred == first
    assert abs(sum(x.share for x in found[-1].languages) - 1) < 1e-6 and found[-1].score == found[-1].languages[0].share
    assert [(x.lang, x.share) for x in found[-2].languages] == [(first, 1.0)]


def test_rows_that_share_an_id_are_judged_by_themselves(spark):
    base = words(11, 80)
    rows = [(1, base), (2, base), (2, words(12, 80)), (3, "12 34"), (3, words(13, 80)), (None, base), (None, "56")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = rows_of(corpus_pipeline.language(spark, docs, SF_DIR))
    assert Counter(kept) == Counter(r for r in rows if r[1] not in ("12 34", "56"))
    left = rows_of(corpus_pipeline.near_copies(spark, docs, SF_DIR))
    assert Counter(left) == Counter(r for k, r in enumerate(rows) if k != 1)


def test_pipeline_stages(spark):
    """The columns stay up to the last stage, decisions take effect, and each stage equals its operator."""
    docs = documents(spark, SF_DIR)
    before, texts = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, SF_DIR).collect(), docs.schema)
        assert after.columns == docs.columns
        texts[name] = rows_of(after)
        before = after
    clean = {i for i, t in rows_of(docs) if t and re.search(r"[^\W\d_]", t)}
    assert {i for i, _ in texts["language"]} == clean
    lines = {(i, n) for i, _, n, _ in expected_lines(texts["language"])}
    left = dict(texts["lines"])
    assert all(len((dict(texts["language"])[i]).split("\n")) - len(left[i].split("\n")) == n for i, n in lines if i in left)
    groups = expected_components(texts["lines"])
    assert {i for i, _ in texts["near copies"]} == {i for i, _, c in groups if i == c}
    removed = {i: (n, size) for i, size, n, _, _ in expected_passages(texts["near copies"], 100)}
    assert all(len(t.encode()) <= removed[i][1] - removed[i][0] for i, t in texts["passages"])
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in texts["passages"]}
    tokens = lambda rows: Counter({(r.doc_id, r.doc_tokens): sum(x.length for x in rows if x.doc_id == r.doc_id) for r in rows})
    assert tokens(corpus_pipeline.run(spark, SF_DIR).collect()) == tokens(packed)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_documents(spark), SF_DIR).columns == odd_documents(spark).columns
