"""Classifiers, graph search, token counts, pieces and the pipeline."""

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from churnlake.llm import factorization, graph_search, queries, sentence_pieces, token_counts

SF_DIR = "/root/testdata/sf0.001"


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.Generator(np.random.PCG64(1))
    place = np.full(1 << factorization.HASH_BITS, -1, np.int32)
    place[:20] = np.arange(20)
    weights, factors = rng.normal(size=20), rng.normal(size=(20, 3))
    whole = np.arange(20) < 4
    machine = factorization.Machine(0.3, place, whole, weights, factors)
    rows = [[1, 5, 6], [], [0, 3, 7, 19, 400]]
    first = np.cumsum([0, *map(len, rows)])
    scores = machine.scores(np.concatenate(rows).astype(int), first)
    for row, score in zip(rows, scores, strict=True):
        own = [f for f in row if f < 20]
        scale = 1 / np.sqrt(sum(not whole[f] for f in own) + 1)
        x = {f: 1.0 if whole[f] else scale for f in own}
        total = 0.3 + sum(weights[f] * x[f] for f in own)
        total += sum(
            factors[f] @ factors[g] * x[f] * x[g] for f in own for g in own if f < g
        )
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_interactions_are_learned():
    """Label 1 needs both words; neither alone tells much."""
    rng = np.random.Generator(np.random.PCG64(6))
    both = rng.random((4000, 2)) < 0.5
    rows = [[10 + i for i in range(2) if pair[i]] + [int(rng.integers(20, 40))] for pair in both]
    first = np.cumsum([0, *map(len, rows)])
    labels = (both[:, 0] ^ both[:, 1]).astype(float)
    machine = factorization.train(np.concatenate(rows), first, labels)
    assert ((machine.scores(np.concatenate(rows), first) >= 0.5) == labels).mean() > 0.95


@pytest.mark.parametrize("neutral", [1, 10])
def test_interactions_are_learned_among_many_telling_words(neutral):
    """Half the rows have words that tell the label alone (150 of them), the
    others have label 1 if exactly one of two words is there, as it may be in any."""
    rng = np.random.Generator(np.random.PCG64(6))
    labels, rows = rng.integers(0, 2, 8000), []
    alone = rng.random(8000) < 0.5
    for n, pair in enumerate(rng.random((8000, 2)) < 0.5):
        row = [10 + i for i in range(2) if pair[i]]
        if alone[n]:
            row += list(1000 + 75 * labels[n] + rng.choice(75, 2, replace=False))
        else:
            labels[n] = pair[0] ^ pair[1]
        rows.append(np.array(row + list(5000 + rng.choice(2000, neutral, replace=False))))
    learned, held = rows[:4000], rows[4000:]
    first = np.cumsum([0, *map(len, learned)])
    machine = factorization.train(np.concatenate(learned), first, labels[:4000].astype(float))
    assert machine.place[10] >= 0 and machine.place[11] >= 0
    scores = machine.scores(np.concatenate(held), np.cumsum([0, *map(len, held)]))
    right = (scores >= 0.5) == labels[4000:]
    assert right[alone[4000:]].mean() > 0.95
    assert right[~alone[4000:]].mean() > 0.95


def test_labels_of_one_kind_or_none_give_a_constant(spark, odd, none):
    for labels in ([], [(1, 1), (2, 1), (None, 1), (3, None), (1, 1)]):
        known = spark.createDataFrame(labels, "doc_id long, label int")
        machine = factorization.fit(odd, known, structure=True)
        scored = factorization.score(odd, machine, structure=True)
        assert scored.count() == odd.count()
        assert scored.schema["doc"].dataType == odd.schema
        assert scored.select("score").distinct().count() == 1
        assert factorization.score(none, machine, structure=True).count() == 0


@pytest.mark.parametrize(
    ("name", "label", "least"),
    [("op4_quality_machine", "quality", 0.9), ("op9_toxicity_machine", "toxic", 0.9)],
)
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    scored = queries.QUERIES[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = scored.join(labels, "doc_id").where("held_out")
    assert held.select(F.avg((F.col(label) == F.col("predicted")).cast("int"))).first()[0] > least


def test_graph_search_recall_ties_and_unusable_vectors(spark):
    rng = np.random.Generator(np.random.PCG64(9))
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    vectors[2000:2400] = vectors[100]
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(vectors)]
    rows += [(5, rows[5][1]), (9000, None), (9050, [0.0] * 16), (9100, [float("nan")] * 16),
             (9150, [None] * 16), (9200, []), (9250, [1.0, 2.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = graph_search.usable(df)
    asked = usable.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    found = graph_search.nearest(asked, graph_search.build_index(usable, k=5), k=5).collect()
    unit = vectors.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    by_query = {}
    for row in sorted(found, key=lambda row: (row.query_id, row.rank)):
        by_query.setdefault(row.query_id, []).append(row.vec_id)
    assert set(by_query) == set(range(0, 3000, 50))
    hits = 0
    for query, got in by_query.items():
        score = np.round(unit @ unit[query], 9)
        score[query] = -2
        truth = np.lexsort((np.arange(3000), -score))[:5]
        hits += len(set(got) & set(truth.tolist()))
        assert len(got) == 5
    assert hits / (5 * len(by_query)) >= 0.95
    assert by_query[2000] == [100, 2001, 2002, 2003, 2004]
    few = usable.where("vec_id < 3")
    asked = few.where("vec_id = 0").withColumnRenamed("vec_id", "query_id")
    index = graph_search.build_index(few, k=5)
    assert graph_search.nearest(asked, index, k=5).count() == 2
    assert graph_search.nearest(asked.where("false"), index, k=5).count() == 0
    empty = graph_search.build_index(few.where("false"), k=5)
    assert graph_search.nearest(asked, empty, k=5).count() == 0


def test_graph_search_of_huge_and_tiny_components(spark, monkeypatch):
    """Also with many shards: lengths of vectors, hot shards and batches do not matter."""
    monkeypatch.setattr(graph_search, "SHARD_ROWS", 40)
    rng = np.random.Generator(np.random.PCG64(3))
    vectors = rng.normal(size=(300, 4)) * 10.0 ** rng.integers(-200, 200, (300, 1))
    rows = [(n, v.tolist()) for n, v in enumerate(vectors)] + [(1000 + n, [1.0, float(n)]) for n in range(9)]
    usable = graph_search.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    asked = usable.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    index = graph_search.build_index(usable, k=5)
    assert index.select("length", "shard").distinct().count() > 5
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = graph_search.nearest(asked, index, k=5).where("query_id < 1000").collect()
    assert len(found) == 150
    for row in found:
        score = unit @ unit[row.query_id]
        score[row.query_id] = -2
        assert row.score == pytest.approx(np.sort(score)[-row["rank"]], abs=1e-12)


def test_section_tokens_against_single_tokens(odd, none):
    encoding, _ = token_counts.load(token_counts.VOCABULARY)
    assert isinstance(encoding, tiktoken.Encoding)
    found, expected = {}, {}
    for row in token_counts.section_tokens(odd).collect():
        found.setdefault(row.doc_id, []).append(row)
    for key, text in [(r.doc_id, r.text or "") for r in odd.collect()]:
        data = text.encode()
        lines = data.split(b"\n")
        lines = [x + b"\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        owner = [n for n, line in enumerate(lines) for _ in line]
        counts, crossing, at = [0] * len(lines), [0] * len(lines), 0
        for token in encoding.encode_ordinary(text):
            size = len(encoding.decode_single_token_bytes(token))
            chars = [0] * len(lines)
            for place in range(at, at + size):
                chars[owner[place]] += (data[place] & 0xC0) != 0x80
            touched = set(owner[at : at + size])
            best = max(sorted(touched), key=lambda n: chars[n])
            counts[best] += 1
            crossing[best] += len(touched) > 1
            at += size
        sections = [(len(x.decode()), c, k) for x, c, k in zip(lines, counts, crossing, strict=True)]
        expected.setdefault(key, []).extend(
            (n, sum(len(line.decode()) for line in lines[:n]), *section)
            for n, section in enumerate(sections)
        )
    columns = ("section", "first_char", "n_chars", "n_tokens", "n_crossing")
    assert {
        key: sorted(tuple(r[name] for name in columns) for r in rows) for key, rows in found.items()
    } == {key: sorted(rows) for key, rows in expected.items()}
    assert token_counts.section_tokens(none).count() == 0


def brute_pieces(text, scores, longest, unknown):
    best, back = [0.0] + [-1e300] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            score = scores.get(text[start:end], unknown if end - start == 1 else None)
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, start
    return best[-1]


def test_pieces_have_the_best_score_and_decode_to_the_text(odd, none):
    known = sentence_pieces.load(sentence_pieces.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
    ordinary = [
        n for n in range(library.get_piece_size())
        if not (library.is_byte(n) or library.is_control(n) or library.is_unknown(n))
    ]
    scores = {library.id_to_piece(n).replace("▁", " "): library.get_score(n) for n in ordinary}
    texts = ["", "   ", " a  b ", "theand hend, and", "日本語\n\tx", "🙂 ok", "a" * 300, "▁x"]
    texts += [r.text or "" for r in odd.collect() if len(r.text or "") < 3000]
    ids, first = sentence_pieces.encode([t.encode() for t in texts], known)
    again = sentence_pieces.decode(ids, first, known)
    assert [x.decode() for x in again] == [t.replace("▁", " ") for t in texts]
    for text, low, high in zip(texts, first[:-1], first[1:], strict=True):
        spaced = " " + text.replace("▁", " ") if text else ""
        own, total, at = ids[low:high].tolist(), 0.0, 0
        while at < len(own):
            if library.is_byte(own[at]):
                lead = int(library.id_to_piece(own[at])[3:5], 16)
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                total += known.unknown
            else:
                total += library.get_score(own[at])
                at += 1
        units = [spaced] if len(spaced) < 2 else [""]
        if len(spaced) >= 2:
            units = [spaced[0]]
            for before, char in zip(spaced, spaced[1:]):
                if char == " " and before != " ":
                    units.append("")
                units[-1] += char
        best = sum(brute_pieces(u, scores, known.longest, known.unknown) for u in units)
        assert total == pytest.approx(best)
    encoded = sentence_pieces.encode_pieces(odd)
    assert encoded.where("not round_trip").count() == 0
    decoded = sentence_pieces.decode_pieces(encoded.select("piece_ids", "doc.text"))
    assert decoded.where("decoded != coalesce(text, '')").count() == 0
    assert sentence_pieces.encode_pieces(none).count() == 0


def test_batches_do_not_change_the_pieces():
    known = sentence_pieces.load(sentence_pieces.MODEL)
    texts = [b"some words", b"more words, some words", "ünïcode \n x".encode()]
    together, first = sentence_pieces.encode(texts, known)
    for text, low, high in zip(texts, first[:-1], first[1:], strict=True):
        assert sentence_pieces.encode([text], known)[0].tolist() == together[low:high].tolist()
    assert isinstance(pa.array(together), pa.Array)


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(spark, docs, SF_DIR)
        docs = corpus_pipeline.stage(docs, "test")
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.schema == before.schema or [f.dataType for f in docs.schema] == [
                f.dataType for f in before.schema
            ]
    assert sizes[1] >= sizes[2] == sizes[3] >= sizes[4] == sizes[5] > 0
    assert sizes[0] > sizes[2]


def test_pipeline_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, SF_DIR), "odd")
        assert docs.columns == ["doc_id", "lang", "source", "n_pieces", "piece_ids"]


def test_every_query_gives_one_row_per_document(spark):
    size = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name, query in queries.QUERIES.items():
        if name not in ("op7_pruned_graph", "op8_section_tokens"):
            assert query(spark, SF_DIR).count() == size, name
