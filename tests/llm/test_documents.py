"""The operators on documents against brute force, on odd rows and empty tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlake.llm import host_rules, minhash, mixing, sharding, substrings, words


def words_of(seed, count):
    rng = np.random.Generator(np.random.PCG64(seed))
    return [f"w{n}" for n in rng.integers(0, 10**6, count)]


def texts_of(df):
    return [(row.doc_id, row.text) for row in df.select("doc_id", "text").collect()]


def test_words_and_hashes_do_not_depend_on_the_chunk(monkeypatch):
    column = pa.array(["a b", None, "", "  x\ty ", "ab" * 30 + " z", "q", "É a"])
    whole = words.find_words(column, lower=True)
    monkeypatch.setattr(words, "CHUNK", 16)
    parts = words.find_words(column, lower=True)
    assert whole.hashes.tolist() == parts.hashes.tolist()
    assert whole.first.tolist() == parts.first.tolist() == [0, 2, 2, 2, 4, 6, 7, 9]
    assert whole.hashes[0] == whole.hashes[8]


def test_shards_are_even_and_slots_gapless(odd, none):
    found = sharding.shard_documents(odd, 4).collect()
    assert len(found) == odd.count()
    sizes = Counter(row.shard for row in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(row.slot for row in found if row.shard == shard) == list(range(size))
    expected = Counter(
        (key, len((text or "").encode()) + 16, zlib.crc32((text or "").encode()))
        for key, text in texts_of(odd)
    )
    assert Counter((row.doc_id, row["size"], row.text_crc32) for row in found) == expected
    assert sharding.shard_documents(none, 4).count() == 0


def test_keys_overflow_clockwise_and_few_move():
    counts = {cell: 1 + cell % 3 for cell in range(0, sharding.CELLS, 7)}

    def owners(shards, slack):
        out = {}
        for cell, low, high, shard, _ in sharding.lay_out(counts, shards, slack):
            out.update({(cell, rank): shard for rank in range(low, high)})
        return out

    before, after = owners(20, 0.25), owners(21, 0.25)
    assert len(before) == sum(counts.values())
    assert max(Counter(before.values()).values()) <= 1.25 * len(before) / 20 + 1
    assert sum(before[key] != after[key] for key in before) < len(before) / 5


def walk(counts, shards, slack, virtual_nodes):
    """Key by key: from its cell clockwise to the first node whose shard has room,
    the keys in rounds of one node each, as bounded loads are defined here."""
    nodes = sorted(
        (zlib.crc32(f"shard {s} node {n}".encode()) % sharding.CELLS, s)
        for s in range(shards)
        for n in range(virtual_nodes)
    )
    room = sharding.capacities(sum(counts.values()), shards, slack)
    owners, used, waiting = {}, [0] * shards, []
    for cell in sorted(counts):
        at = next((i for i, (place, _) in enumerate(nodes) if place >= cell), 0)
        waiting += [((cell, rank), at) for rank in range(counts[cell])]
    while waiting:
        later = []
        for key, at in waiting:
            shard = nodes[at][1]
            if used[shard] < room[shard]:
                used[shard] += 1
                owners[key] = shard
            else:
                later.append((key, at))
        waiting = []
        for key, at in later:
            while used[nodes[at][1]] == room[nodes[at][1]]:
                at = (at + 1) % len(nodes)
            waiting.append((key, at))
    return owners


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_the_ring_equals_a_plain_walk(slack):
    counts = {cell: 1 + cell % 5 for cell in range(0, sharding.CELLS, 97)} | {300: 400}
    found = {}
    for cell, low, high, shard, _ in sharding.lay_out(counts, 7, slack, 8):
        found.update({(cell, rank): shard for rank in range(low, high)})
    assert found == walk(counts, 7, slack, 8)


def test_one_doc_id_may_hold_most_rows(spark):
    rows = [(1, "same")] * 3000 + [(1, f"text {n % 50}") for n in range(1000)]
    rows += [(n, "x") for n in range(500)] + [(None, None)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard_documents(docs, 8).collect()
    sizes = Counter(row.shard for row in found)
    assert len(found) == 5000 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(row.slot for row in found if row.shard == shard) == list(range(size))


def test_many_texts_of_one_doc_id(spark):
    passage = " ".join(words_of(9, 60))
    rows = [(1, passage)] + [(7, f"{passage} tail {n}") for n in range(500)] + [(7, f"{passage} tail 0")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = substrings.remove_repeats(docs, window=50).collect()
    assert len(found) == 1001
    assert all(row.n_removed == (60 if row.doc.doc_id == 7 else 0) for row in found)


def test_mixing_takes_any_column_name_and_refuses_too_many_topics(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(n, "a b c", "en", f"s{n % 2}", 7, n) for n in range(20)],
        "doc_id long, text string, lang string, source string, _tokens int, topic_of long",
    )
    mixed = mixing.mix_sources(docs)
    assert mixed.schema["doc"].dataType == docs.schema
    assert mixed.where("doc._tokens != 7 or tokens != 3").count() == 0
    monkeypatch.setattr(mixing, "MAX_PAIRS", 10)
    with pytest.raises(ValueError, match="more than 10 pairs"):
        mixing.mix_sources(docs, topic=F.col("topic_of").cast("string"))


def brute_sets(text, length):
    own = [w.lower() for w in (text or "").encode().split()]
    if 0 < len(own) < length:
        return {tuple(own)}
    return {tuple(own[i : i + length]) for i in range(len(own) - length + 1)}


def brute_components(docs, length, percent):
    sets = [(key, brute_sets(text, length)) for key, text in docs if key is not None]
    root = {key: key for key, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {key: find(key) for key in root}


@pytest.mark.parametrize(("length", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_on_odd_rows(odd, none, length, percent):
    found = minhash.near_duplicates(odd, words=length, percent=percent).collect()
    docs = texts_of(odd)
    expected = brute_components(docs, length, percent)
    assert len(found) == len(docs)
    for row in found:
        assert row.component_id == expected.get(row.doc_id)
        assert row.kept == (row.doc_id is None or row.component_id == row.doc_id)
    assert Counter((r.doc_id, r.n_shingles) for r in found) == Counter(
        (key, len(brute_sets(text, length))) for key, text in docs
    )
    assert minhash.near_duplicates(none).count() == 0


def test_near_duplicates_across_a_hot_bucket(spark, monkeypatch):
    """Chains of edits around the threshold, in blocks smaller than the group."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PAIRS", 50)
    rng = np.random.Generator(np.random.PCG64(5))
    base, docs = [f"w{i}" for i in range(150)], []
    for key in range(120):
        text = list(base)
        for at in rng.choice(150, rng.integers(0, 14), replace=False):
            text[at] = f"e{rng.integers(0, 4)}"
        docs.append((1000 - key, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = minhash.near_duplicates(df, words=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(docs, 3, 85)


def test_collision_corrected_estimate():
    rng = np.random.Generator(np.random.PCG64(2))
    errors = []
    for share in (0.5, 0.8, 0.95):
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
            both = int(4000 * share)
            cut = both + (4000 - both) // 2
            x, y = np.unique(pool[:cut]), np.unique(np.append(pool[:both], pool[cut:]))
            equal = (minhash.sketch(x) == minhash.sketch(y)).mean()
            errors.append(minhash.corrected(equal, len(x), len(y)) - share)
    assert abs(np.mean(errors)) < 0.01
    assert np.abs(errors).max() < 0.2


def brute_repeats(docs, window):
    first, out = {}, []
    for key, text in docs:
        own = (text or "").encode().split()
        for at in range(len(own) - window + 1):
            if key is not None:
                name = tuple(own[at : at + window])
                first[name] = min(key, first.get(name, key))
    for key, text in docs:
        own = (text or "").encode().split()
        gone = [False] * len(own)
        for at in range(len(own) - window + 1):
            if key is not None and first[tuple(own[at : at + window])] < key:
                gone[at : at + window] = [True] * window
        kept = b" ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((key, len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def cleaned(df, window):
    rows = substrings.remove_repeats(df, window=window)
    digest = F.sha2("kept_text", 256)
    return Counter(map(tuple, rows.select("doc.doc_id", "n_words", "n_removed", digest).collect()))


def test_repeats_on_odd_rows(odd, none):
    assert cleaned(odd, 50) == brute_repeats(texts_of(odd), 50)
    assert substrings.remove_repeats(odd).schema["doc"].dataType == odd.schema
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("group", [4, 4096])
def test_repeats_in_groups_that_are_split(spark, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP_ROWS", group)
    rng = np.random.Generator(np.random.PCG64(8))
    passage = [f"p{i}" for i in range(70)]
    docs = []
    for key in range(60):
        own = [f"u{key}_{i}" for i in range(rng.integers(0, 40))]
        low = int(rng.integers(0, 25))
        docs.append((key, " ".join(own + passage[low:] + own[::-1])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert cleaned(df, 50) == brute_repeats(docs, 50)


def test_counts_and_host_verdicts(odd, none):
    found = host_rules.judge_documents(odd).collect()
    assert len(found) == odd.count()
    by_text = {}
    for key, text in texts_of(odd):
        text = text or ""
        own = [w.decode() for w in text.encode().split()]
        windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        by_text.setdefault(key, []).append(
            (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text),
             len(lines) - len(set(lines)), len(covered))
        )
    for row in found:
        counts = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert counts in by_text[row.doc_id]
        assert row.base_failed == (row.n_words < 50 or 2 * row.n_repeat_words > row.n_words)
        assert row.kept == (not row.base_failed and row.host_kept)
    assert host_rules.judge_documents(none).count() == 0


def test_few_failures_do_not_condemn_a_small_host(spark):
    rows = [("big", n < 100) for n in range(1000)] + [("bad", n < 95) for n in range(100)]
    rows += [(f"h{h}", n < h % 3) for h in range(30) for n in range(20)]
    rows += [("tiny", True), (None, False)]
    verdicts = {
        row.host: row
        for row in host_rules.host_verdicts(
            spark.createDataFrame(rows, "host string, failed boolean")
        ).collect()
    }
    assert not verdicts["bad"].host_kept
    assert verdicts["big"].host_kept
    assert verdicts["tiny"].host_rate < 1
    assert verdicts[None].n_docs == 1


def test_mixture_meets_its_targets(spark, none, odd):
    rng = np.random.Generator(np.random.PCG64(4))
    rows = [
        (key, " ".join(["w"] * int(rng.integers(1, 60))), "en" if rng.random() < 0.8 else "de",
         "hot" if rng.random() < 0.4 else f"s{rng.integers(0, 5)}", f"t{rng.integers(0, 3)}")
        for key in range(4000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    targets = mixing.Targets(keep=0.2, shares={"lang": {"en": 0.5, "de": 0.5}})
    mixed = mixing.mix_sources(df, targets, topic=F.col("topic")).cache()
    rows = mixed.select("doc.lang", "doc.source", "topic", "tokens", "weight", "probability").toPandas()
    mass = rows.weight * rows.tokens
    assert mass.sum() == pytest.approx(rows.tokens.sum())
    assert mass[rows.lang == "de"].sum() == pytest.approx(rows.tokens.sum() / 2, rel=1e-5)
    for name, temper in (("source", 0.7), ("topic", 0.7)):
        want = rows.groupby(name).tokens.sum() ** temper
        got = mass.groupby(rows[name]).sum()
        assert (got / got.sum()).to_numpy() == pytest.approx((want / want.sum()).to_numpy(), rel=1e-4)
    assert (rows.probability * rows.tokens).sum() == pytest.approx(0.2 * rows.tokens.sum(), rel=1e-6)
    kept = mixed.where("kept").agg(F.sum("tokens")).first()[0]
    assert kept == pytest.approx(0.2 * rows.tokens.sum(), rel=0.1)
    assert mixing.mix_sources(odd).count() == odd.count()
    assert mixing.mix_sources(none).count() == 0


@pytest.mark.parametrize("german", [0.35, 0.5])
def test_expected_sample_meets_its_targets_with_sure_cells(spark, caplog, german):
    """A fifth of the tokens is German: 0.35 of half of all can be had, 0.5 not."""
    rng = np.random.Generator(np.random.PCG64(4))
    rows = [
        (key, " ".join(["w"] * int(rng.integers(1, 60))), "en" if rng.random() < 0.8 else "de",
         "hot" if rng.random() < 0.4 else f"s{rng.integers(0, 5)}", f"t{rng.choice(3, p=[0.5, 0.3, 0.2])}")
        for key in range(4000)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    targets = mixing.Targets(keep=0.5, shares={"lang": {"en": 1 - german, "de": german}})
    mixed = mixing.mix_sources(df, targets, topic=F.col("topic"))
    rows = mixed.select("doc.lang", "doc.source", "topic", "tokens", "probability").toPandas()
    expected = rows.probability * rows.tokens
    assert rows.probability.between(0, 1).all()
    assert (rows.probability == 1).any()
    assert expected.sum() == pytest.approx(0.5 * rows.tokens.sum(), rel=1e-6)
    for name, temper in (("source", 0.7), ("topic", 0.7)):
        want = rows.groupby(name).tokens.sum() ** temper
        got = expected.groupby(rows[name]).sum()
        assert (got / got.sum()).to_numpy() == pytest.approx((want / want.sum()).to_numpy(), rel=1e-4)
    share = expected[rows.lang == "de"].sum() / expected.sum()
    reported = [r.getMessage() for r in caplog.records if r.levelname == "WARNING"]
    if german == 0.35:
        assert share == pytest.approx(0.35, rel=1e-4)
        assert not reported
    else:
        there = rows.tokens[rows.lang == "de"].sum() / (0.5 * rows.tokens.sum())
        assert share == pytest.approx(there, rel=1e-4)
        assert f"mixture: lang 'de' has target 0.500000, achieved {share:.6f}" in reported
        assert any(line.startswith("mixture: lang 'en' has target 0.500000") for line in reported)


def test_words_and_forms_of_a_text(spark, odd):
    text = F.coalesce("text", F.lit(""))
    forms = spark.createDataFrame(
        [("",), (" | |",), ("ABC DEf\n",), ("a\x0bb\x1fc\u2003d",), ("w " * 100,), ("w\t\n" * 1500,)],
        "text string",
    ).unionByName(odd.select("text"))
    for row in forms.select(
        text.alias("text"),
        mixing.n_words(text).alias("words"),
        mixing.genre(text, mixing.n_words(text)).alias("form"),
    ).collect():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", row.text))
        capitals = len(re.findall("[A-Z]", row.text))
        by_size = [(100, "note"), (400, "page"), (1500, "article")]
        form = next((name for size, name in by_size if words < size), "book")
        form = "loud" if capitals * 2 > len(row.text) else form
        form = "table" if row.text.count("|") * 10 > words else form
        assert (row.words, row.form) == (words, form)
