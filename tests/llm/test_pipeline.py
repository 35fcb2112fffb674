"""The pipeline, stage by stage, against plain versions on a small corpus."""

import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from test_documents import brute_components, brute_repeats

import corpus_pipeline
from churnlake.llm import factorization, mixing, sentence_pieces

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, size):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrs')}{rng.randrange(60)}" for _ in range(size)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean and toxic texts, copies, near copies, shared passages, nulls."""
    rng = random.Random(8)
    passage = sentence(rng, 70)
    rows, labels = [], []
    for n in range(160):
        words = sentence(rng, rng.randrange(60, 140))
        toxic = n % 5 == 0
        if toxic:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(["idiotic", "rubbish"]))
        if n % 7 == 3:
            words[20:20] = passage
        rows.append((n, " ".join(words), rng.choice(["en", "de", None]), f"s{n % 3}"))
        labels.append((n, int(toxic)))
    for n in range(160, 200):
        words = rows[n - 150][1].split()
        if n % 2:
            words[5] = "changed"
        rows.append((n, "\n".join(words) if n % 3 else " ".join(words).upper(), "en", "s1"))
    rows += [(200, None, "en", "s0"), (201, "", None, None), (202, " \n ", "de", "s1"), (203, "one word", "en", "s2")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(*row, len(row[1] or "")) for row in rows], COLUMNS)
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """What each stage was given and what it kept."""
    docs, kept = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        found = corpus_pipeline.stage(step(spark, docs, corpus), "test")
        kept.append((name, docs, found))
        docs = found
    return {name: (before.collect(), after.collect()) for name, before, after in kept}


def by_id(rows):
    return {row.doc_id: row for row in rows}


def test_toxic_documents_go(spark, corpus, stages):
    before, after = stages["toxicity"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    labels = spark.read.parquet(f"{corpus}/labels.parquet").withColumnRenamed("toxic", "label")
    machine = factorization.fit(docs, labels, structure=False)

    features, first = factorization.text_features(pa.array([row.text for row in before]), False)
    kept = set()
    for row, low, high in zip(before, first[:-1], first[1:], strict=True):
        at = [machine.place[f] for f in features[low:high] if machine.place[f] >= 0]
        scale = 1 / np.sqrt(len(at) + 1)
        total = machine.bias + sum(float(machine.weights[a]) * scale for a in at)
        for n, a in enumerate(at):
            for b in at[:n]:
                total += float(machine.factors[a] @ machine.factors[b]) * scale * scale
        if 1 / (1 + np.exp(-total)) < corpus_pipeline.TOXIC:
            kept.add(row.doc_id)
    assert set(by_id(after)) == kept
    clean = {n for n in range(160) if n % 5}
    assert clean <= kept and not kept & {n for n in range(160) if n % 5 == 0}


def test_one_of_each_group_stays(stages):
    before, after = stages["near duplicates"]
    component = brute_components([(row.doc_id, row.text) for row in before], 5, 80)
    assert sorted(map(tuple, after)) == sorted(
        tuple(row) for row in before if component[row.doc_id] == row.doc_id
    )
    assert len(after) < len(before)


def test_repeated_passages_are_cut_from_the_text(stages):
    before, after = stages["repeated passages"]
    expected = {row[0]: row for row in brute_repeats([(r.doc_id, r.text) for r in before], 50)}
    own = by_id(before)
    assert {row.doc_id for row in after} == set(own)
    changed = 0
    for row in after:
        _, _, removed, digest = expected[row.doc_id]
        source = own[row.doc_id]
        if not removed:
            assert tuple(row) == tuple(source)
            continue
        changed += 1

        assert hashlib.sha256(row.text.encode()).hexdigest() == digest
        assert row.n_chars == len(row.text)
        assert (row.lang, row.source) == (source.lang, source.source)
    assert changed > 5


def draw(seed, doc_id):
    """A number of [0, 1) by the published hash of the seed, then of the id."""
    first = xxhash.xxh64(struct.pack("<i", seed), 42).intdigest()
    return (xxhash.xxh64(struct.pack("<q", doc_id), first).intdigest() >> 11) / 2**53


def test_the_mixture_is_drawn_by_its_probabilities(spark, stages):
    before, after = stages["source mixture"]
    docs = spark.createDataFrame(before, COLUMNS)
    mixed = {row.doc.doc_id: row for row in mixing.mix_sources(docs).collect()}
    assert len(mixed) == len(before)
    kept = {key for key, row in mixed.items() if draw(17, key) < row.probability}
    assert set(by_id(after)) == kept and 0 < len(kept) < len(before)
    own = by_id(before)
    assert all(tuple(row) == tuple(own[row.doc_id]) for row in after)


def test_pieces_of_what_is_left(stages):
    before, after = stages["piece ids"]
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    known = sentence_pieces.load(sentence_pieces.MODEL)
    own, found = by_id(before), by_id(after)
    assert set(own) == set(found)
    for key, row in found.items():
        ids = np.array(row.piece_ids, np.int64)
        assert row.n_pieces == len(ids) and (row.lang, row.source) == (own[key].lang, own[key].source)
        text = sentence_pieces.decode(ids, np.array([0, len(ids)]), known)[0].decode() if len(ids) else ""
        assert text == (own[key].text or "")
        total = sum(library.get_score(int(n)) for n in ids)
        theirs = sum(library.get_score(n) for n in library.encode(own[key].text or ""))
        assert total >= theirs - 1e-3 or not len(ids)


def test_run_gives_the_rows_of_the_last_stage(spark, corpus, stages):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, stages["piece ids"][1]), key=str)


def test_weights_equal_plain_raking(spark):
    """Iterative proportional fitting over a dictionary of cells."""
    rng = random.Random(3)
    cells = {
        (s, l, t): rng.randrange(1, 900)
        for s in "abcd" for l in ("en", "de") for t in ("page", "note", "book") if rng.random() < 0.9
    }
    targets = mixing.Targets()
    frame = spark.createDataFrame(
        [(*key, tokens) for key, tokens in cells.items()], "source string, lang string, topic string, tokens long"
    )
    found = {
        (r.source, r.lang, r.topic): r.weight for r in mixing.cell_weights(frame, targets).collect()
    }
    mass, total = dict(cells), sum(cells.values())
    goals = []
    for axis, name in enumerate(("source", "lang", "topic")):
        sums = {}
        for key, tokens in cells.items():
            sums[key[axis]] = sums.get(key[axis], 0) + tokens
        powers = {value: tokens ** targets.temper[name] for value, tokens in sums.items()}
        goals.append({value: total * power / sum(powers.values()) for value, power in powers.items()})
    for _ in range(500):
        for axis, goal in enumerate(goals):
            sums = {value: 0.0 for value in goal}
            for key, tokens in mass.items():
                sums[key[axis]] += tokens
            mass = {key: tokens * goal[key[axis]] / sums[key[axis]] for key, tokens in mass.items()}
    for key, tokens in cells.items():
        assert found[key] == pytest.approx(mass[key] / tokens, rel=1e-4)
    plain = mixing.cell_probabilities(mixing.cell_weights(frame, targets), mixing.Targets(keep=0.1)).collect()
    kept = sum(r.probability * r.tokens for r in plain)
    assert kept == pytest.approx(0.1 * total, rel=1e-6)
    for r in plain:
        key = (r.source, r.lang, r.topic)
        assert r.probability == pytest.approx(0.1 * mass[key] / r.tokens, rel=1e-3)
