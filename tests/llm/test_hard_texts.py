"""Texts made to break an operator: words of equal rolling hash, very long runs,
one doc_id with very many rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlake.llm import factorization, minhash, sentence_pieces, substrings, token_counts, words

import pyarrow as pa


def twins(bits=11):
    """Two different words whose polynomials are equal modulo 2**64 for any odd base."""
    first = "".join("ab"[bin(n).count("1") % 2] for n in range(1 << bits))
    return first, first.translate(str.maketrans("ab", "ba"))


def test_the_twins_have_one_rolling_hash():
    column = pa.array(twins())
    assert len(set(words.find_words(column, rolling=True).hashes.tolist())) == 1
    found = words.find_words(column)
    assert len(set(found.hashes.tolist())) == len(set(found.ids.tolist())) == 2


def test_words_of_equal_rolling_hash_are_different_words(spark):
    one, two = twins()
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert minhash.near_duplicates(docs).where("kept").count() == 2
    common = " ".join(f"w{n}" for n in range(49))
    docs = spark.createDataFrame(
        [(1, f"{common} {one}"), (2, f"{common} {two}"), (3, f"{common} {two}")],
        "doc_id long, text string",
    )
    removed = substrings.remove_repeats(docs, window=50).select("doc.doc_id", "n_removed")
    assert dict(map(tuple, removed.collect())) == {1: 0, 2: 0, 3: 50}
    known = sentence_pieces.load(sentence_pieces.MODEL)
    texts = [one.encode(), two.encode()]
    ids, first = sentence_pieces.encode(texts, known)
    assert sentence_pieces.decode(ids, first, known) == texts


def test_numbered_shingles_equal_sets_of_words():
    rng = np.random.Generator(np.random.PCG64(5))
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 1, 2, 3, 5, 40, 41)]
    numbers = words.find_words(pa.array(texts)).numbered_shingles(3)
    own = [t.split() for t in texts]
    sets = [
        {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
        for w in own
    ]
    for x, a in zip(numbers, sets, strict=True):
        assert len(x) == len(a)
        for y, b in zip(numbers, sets, strict=True):
            assert len(np.intersect1d(x, y)) == len(a & b)


def test_token_counts_of_runs_of_millions(spark):
    encoding, sizes = token_counts.load(token_counts.VOCABULARY)
    for blank in ("\n", " ", "\t ", "　"):
        for text in (blank * 1500, "x" + blank * 1200 + "y z", "a\n" + blank * 2999 + "\n3"):
            assert token_counts.encode(encoding, text) == encoding.encode_ordinary(text)
    texts = [" " * 5_000_000 + "x", "\n" * 5_000_000, "a" * 5_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = token_counts.section_tokens(docs).groupBy("doc_id").agg(
        F.sum("n_chars").alias("chars"), F.sum("n_tokens").alias("tokens")
    )
    found = {row.doc_id: row for row in rows.collect()}
    assert [found[n].chars for n in range(3)] == [5_000_001, 5_000_000, 5_000_000]
    assert found[2].tokens == len(encoding.encode_ordinary(texts[2]))


def test_the_sample_is_bounded_in_documents_and_features(spark):
    rng = np.random.Generator(np.random.PCG64(2))
    rows = [(1, f"text {n}") for n in range(10_000)]
    rows += [(n, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 2000))) for n in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame(
        [(n, n % 2) for n in range(1, 40)] * 2, "doc_id long, label int"
    )
    sample = factorization.labelled_sample(docs, labels, structure=False, sample=20)
    assert sample.count() == sample.select("doc_id").distinct().count() == 20
    sizes = [r.size for r in sample.collect()]
    assert factorization.labelled_sample(docs, labels, structure=False).count() == 39
    few = factorization.labelled_sample(docs, labels, structure=False, cells=16 * max(sizes))
    total = few.agg(F.sum("size")).first()[0]
    assert 0 < total <= 16 * max(sizes) and few.count() < 39
    machine = factorization.fit(docs, labels, structure=False)
    assert factorization.score(docs, machine, structure=False).count() == len(rows)


def test_a_sample_of_long_texts(spark):
    docs = spark.range(1, 25).select(
        F.col("id").alias("doc_id"),
        F.expr("array_join(transform(sequence(1, 20000), i -> concat('w', hash(id, i))), ' ')").alias("text"),
    )
    labels = spark.range(1, 25).selectExpr("id as doc_id", "int(id % 2) as label")
    machine = factorization.fit(docs, labels, structure=False, cells=1 << 18)
    assert len(machine.weights) <= factorization.FEATURES
    assert factorization.score(docs, machine, structure=False).count() == 24


@pytest.mark.parametrize("name", ["size", "_label"])
def test_metadata_is_learned_and_null_is_a_value(spark, name):
    """Texts are equal; only the column tells the label."""
    rows = [(n, "same words", None if n % 3 == 0 else 10 ** (n % 3 + 1)) for n in range(600)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` long")
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 != 1) as label")
    machine = factorization.fit(docs, labels, structure=False, metadata=(name,))
    scored = factorization.score(docs, machine, structure=False, metadata=(name,))
    right = scored.where((F.col("score") >= 0.5) == (F.col("doc.doc_id") % 3 != 1))
    assert right.count() == 600


def plain_features(text):
    """The words of a text and their prefixes, by a plain scan."""
    found, word = set(), ""
    for char in text + " ":
        if char.isascii() and not char.isalpha():
            if word:
                data = word.encode()
                found |= {(0, data)} | {(n, data[:n]) for n in factorization.PREFIXES if len(data) > n}
            word = ""
        else:
            word += char.lower() if char.isascii() else char
    return found


def test_features_are_the_words_and_prefixes():
    texts = ["Some words, some MORE words!", "", None, "ünï-code 4 you", "aaaa aaaaa aaaaaaa"]
    features, first = factorization.text_features(pa.array(texts), False)
    numbers = {}
    for text, low, high in zip(texts, first[:-1], first[1:], strict=True):
        own = plain_features(text or "")
        assert high - low == len(own)
        for other, a, b in zip(texts, first[:-1], first[1:], strict=True):
            both = np.intersect1d(features[low:high], features[a:b])
            assert len(both) == len(own & plain_features(other or ""))
        numbers[text] = features[low:high]


def test_one_step_follows_the_numeric_gradient(monkeypatch):
    """A first step of AdaGrad has the size of the step and the sign of the slope."""
    monkeypatch.setattr(factorization, "STEPS", 1)
    monkeypatch.setattr(factorization, "BATCH", 64)
    rng = np.random.Generator(np.random.PCG64(4))
    rows = [np.sort(rng.choice(12, 4, replace=False)) for _ in range(64)]
    labels = rng.integers(0, 2, 64).astype(float)
    first = np.cumsum([0, *map(len, rows)])
    after = factorization.train(np.concatenate(rows), first, labels)
    monkeypatch.setattr(factorization, "STEPS", 0)
    before = factorization.train(np.concatenate(rows), first, labels)

    def loss(machine):
        scores = machine.scores(np.concatenate(rows), first)
        return -(labels * np.log(scores) + (1 - labels) * np.log(1 - scores)).mean()

    for values, moved in ((before.weights, after.weights), (before.factors, after.factors)):
        for place in np.ndindex(*values.shape):
            kept = values[place]
            values[place] = kept + 1e-5
            high = loss(before)
            values[place] = kept - 1e-5
            slope = (high - loss(before)) / 2e-5
            values[place] = kept
            if abs(slope) > 2e-3:
                assert np.sign(kept - moved[place]) == np.sign(slope)
