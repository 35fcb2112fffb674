"""Source divergence, spelling forms and pair merges against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlake.llm import count_trees, pair_merges, queries, spelling_forms

SF_DIR = "/root/testdata/sf0.001"


def plain_divergence(rows, least=10, listed=10):
    occurrences, documents, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        occurrences[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in documents[lang].items() if n >= least]
        of = {s: {t: occurrences[lang, s][t] for t in kept} for a, s in groups if a == lang}
        whole = {t: sum(of[s][t] for s in of) for t in kept}

        def share(counts, term):
            return 1 + 1000000000 * (counts[term] + 2) // (sum(counts.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        pairs = [(-sum(f(share(of[source], t), share(of[s], t)) for t in kept), s) for s in of if s != source]
        terms = []
        for term in kept:
            p, q = share(of[source], term), share(whole, term)
            if of[source][term] > 0 and p > q:
                terms.append((-f(p, q), term.encode()))
        for rank, (value, item) in enumerate(sorted((v, s.encode()) for v, s in pairs), 1):
            out.append((lang, source, "pair", item.decode(), -value, rank))
        for rank, (value, item) in enumerate(sorted(terms)[:listed], 1):
            out.append((lang, source, "term", item.decode(), -value, rank))
    return sorted(out)


def as_rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def random_documents(seed, size, langs=("en", "", None, "de"), sources=7):
    rng = random.Random(seed)
    common = ["the", "Of", "é", "日本", "zz", "Q", "naïve", "a1b"] + [f"w{chr(97 + n)}" for n in range(26)]
    rows = []
    for n in range(size):
        lang = rng.choice(langs)
        source = None if n % 29 == 0 else f"s{rng.randrange(sources)}"
        words = rng.choices(common, k=rng.randrange(0, 30))
        rows.append((" ".join(words) if n % 31 else None, lang, source))
    rows += [("", "only", "empty"), (None, "only", None), ("alone", "xx", "x")]
    return rows


@pytest.mark.parametrize("settings_", [(4096, 128, 1 << 21), (8, 3, 16), (4, 1, 4)])
def test_divergence_equals_the_plain_sums(spark, monkeypatch, settings_):
    """Also with segments and blocks so small that a language has many."""
    for name, value in zip(("SEGMENT", "BLOCK", "CELLS"), settings_, strict=True):
        monkeypatch.setattr(count_trees, name, value)
    rows = random_documents(3, 400)
    docs = spark.createDataFrame(
        [(*row, 1, "clash") for row in rows], "text string, lang string, source string, n int, term string"
    ).repartition(3)
    assert as_rows(count_trees.divergence(docs)) == plain_divergence(rows)


def test_divergence_of_odd_rows(odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert as_rows(count_trees.divergence(odd, least_documents=2)) == plain_divergence(rows, 2)
    assert as_rows(count_trees.divergence(odd)) == plain_divergence(rows)
    assert count_trees.divergence(none).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((6, 64), np.int64)
    counts[:, :3] = np.arange(18).reshape(6, 3)
    roots, levels, leaves = count_trees.grow(counts)
    assert len(set(roots.tolist())) == 6 and len(leaves) == 18
    # 6 roots; below, one node for all that is empty and one each for the rest.
    assert [len(left) for left, _ in levels] == [6, 7, 7, 7, 7, 13]
    huge = np.array([[10**10, 1], [5, 10**11]])
    roots, levels, leaves = count_trees.grow(huge)
    totals = huge.sum(axis=1)
    price = count_trees.price_pairs(
        roots, levels, leaves, totals, np.array([0]), np.array([1]), count_trees._leaf_prices(2)
    )
    shares = [[1 + 10**9 * (c + 2) // (t + 4) for c in row] for row, t in zip(huge.tolist(), totals.tolist())]
    assert price[0] == sum((p - q) ** 2 // (p + q) for p, q in zip(*shares))


def plain_forms(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(x, y):
        if abs(len(x) - len(y)) > 1 or x == y:
            return False
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        x, y = sorted((x, y), key=len)
        return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    forms, out = {}, []
    for word, n in words.items():
        others = sorted((-words[x], x) for x in words if near(word, x))
        best = others[0] if others and -others[0][0] >= 2 * n else None
        forms[word] = best[1] if best else None
        out.append([word, forms[word], word, n, len(others), -best[0] if best else None])
    for row in out:
        while forms[row[2]]:
            row[2] = forms[row[2]]
    return sorted(map(tuple, out))


def random_words(seed, size, letters="abcé"):
    rng = random.Random(seed)
    rows = []
    for n in range(size):
        words = []
        for _ in range(40):
            word = rng.choice(["abcab", "bbbbbbb", "aaaaaa", "cabéabca"])
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", rng.choice(letters)]) + word[at + rng.randrange(2) :]
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((n if n % 17 else None, rng.choice([" ", "×.", "-"]).join(words)))
    return rows


@pytest.mark.parametrize("group", [4096, 40, 2])
def test_spelling_forms_equal_the_plain_ones(spark, group):
    """Also with groups so small that they are cut down to one place."""
    rows = random_words(7, 60) + [(1, None), (2, ""), (3, "ÀÿÀÿÀ ÀÿÀÿÀÿ ÀÿÀÿÀ ÀÿÀÿÀ ÀÿÀÿÀÿ ÀÿÀÿÀÿ")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n int").repartition(4)
    expected = plain_forms(rows)
    assert len(expected) > 100 and sum(row[1] is not None for row in expected) > 20
    assert as_rows(spelling_forms.spelling_forms(docs, group=group).na.fill("", ["form"])) == sorted(
        (w, f or "", r, n, k, m) for w, f, r, n, k, m in expected
    )


def test_spelling_forms_of_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = {tuple(r) for r in spelling_forms.spelling_forms(odd).collect()}
    assert found == set(plain_forms(rows))
    assert spelling_forms.spelling_forms(none).count() == 0
    # Words of many thousand letters, some of them near.
    long = "ab" * 30_000
    texts = [f"{long} {long}c {long[:500]}x{long[500:]} {'q' * 40_000}"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {len(r.word): r.n_near for r in spelling_forms.spelling_forms(docs).collect()}
    assert set(counts) == {60_000, 60_001, 40_000} and counts[60_000] >= 1 and counts[40_000] == 0


def test_text_is_cut_between_runs(monkeypatch):
    from churnlake.llm import term_counts

    monkeypatch.setattr(term_counts, "STRETCH", 5)
    text = "élan à la carte, ünïcode naïveté x".encode()
    parts = list(term_counts.find_runs(spelling_forms._RUN, text))
    assert len(parts) > 2
    assert [run for part in parts for run in part] == spelling_forms._RUN.findall(text)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(pair_merges.VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    return pair_merges.Encoder(pair_merges.VOCABULARY)


def same(encoder, library, texts):
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        ids = np.frombuffer(ids, np.uint32).astype(np.int64)
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text[:100]
        decoded = pair_merges.decode(ids, encoder.vocabulary).decode()
        assert decoded == library.decode(expected, skip_special_tokens=False), text[:100]


def test_pair_merges_equal_the_library(encoder, library):
    marks = [chr(code) for code in [*range(0x3100), 0xAC00, 0xFEFF, 0x1F600]]
    same(encoder, library, [f"ab{c}cd {c} x{c}{c}'s {c}" for c in marks])
    texts = ["", "  ", "<|endoftext|>a<|startoftext|><|endoftext|>", "a<|ENDOFTEXT|>", "<|endoftext|"]
    texts += ["don't we'll I'M it'st", "İI ǅ ﬁ Å Å é ́x", "日本語" * 50, "x\x1cy\x1dz \x85q"]
    texts += ["a" * n for n in (1, 2, 3, 63, 64, 65, 129, 5000)] + ["ab" * 200 + "!" * 100]
    same(encoder, library, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abtheinAB 's.!12é日́<|endoftext|>\n\x1c"), max_size=80)))
def test_pair_merges_of_any_text(encoder, library, texts):
    same(encoder, library, texts)


def test_forgotten_units_are_encoded_again(library, monkeypatch):
    monkeypatch.setattr(pair_merges, "KNOWN", 5)
    monkeypatch.setattr(pair_merges, "KNOWN_LENGTH", 4)
    monkeypatch.setattr(pair_merges, "STRETCH", 40)
    monkeypatch.setattr(pair_merges, "LEAVES", 8)
    encoder = pair_merges.Encoder(pair_merges.VOCABULARY)
    rng = random.Random(4)
    for _ in range(20):
        same(encoder, library, [" ".join(rng.choices(["a", "long", "longer", "b,", "é!", "the"], k=30)) for _ in range(9)])


def test_a_word_of_half_a_million_letters(encoder, library):
    same(encoder, library, ["thequick" * 62_500])


def test_pair_merge_queries(spark, odd, none, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_pair_merges(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        encoded = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(encoded, skip_special_tokens=False)
        assert row.n_tokens == len(encoded)
        assert row.ids_sha256 == hashlib.sha256(np.array(encoded, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    encoded = pair_merges.encode_merges(odd)
    assert encoded.schema["doc"].dataType == odd.schema
    decoded = pair_merges.decode_merges(encoded.select("doc.text", "ids"))
    for row in decoded.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert (row.ids, row.decoded) == (ids, library.decode(ids, skip_special_tokens=False))
    packed = pair_merges.decode_merges(pair_merges.encode_merges(odd, packed=True, decoded=True).selectExpr("doc", "ids", "decoded AS own"))
    assert packed.where("own != decoded").count() == 0
    assert packed.count() == odd.count()
    nulls = encoded.select(F.lit(None).cast("array<int>").alias("ids"))
    assert pair_merges.decode_merges(nulls).where("decoded is not null").count() == 0
    assert pair_merges.encode_merges(none).count() == 0
    with pytest.raises(ValueError, match="decoded"):
        pair_merges.decode_merges(decoded)
