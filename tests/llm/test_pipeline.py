"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

import random
import re
import zlib

import pytest
from test_text_operators import VOCABULARY, brute_groups, words
from tokenizers import Tokenizer

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(120):
        t = words(rng, rng.randint(20, 80))
        if i % 3 == 1:
            t = " ".join(f"{w} |" for w in t.split())  # junk
        rows.append([i, t])
    passage = words(rng, 30)
    for i in (6, 30, 60):
        rows[i][1] += " " + passage
    rows[9][1] += " password=hunter2222 end"
    near = rows[12][1].split()
    near[0] = "other"
    rows += [[200, rows[12][1]], [201, " ".join(near)], [202, None], [203, ""], [204, words(rng, 2600)]]
    return [(i, t, "aa", "s", len(t or "")) for i, t in rows]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if i % 3 == 1 else 1, 0) for i, *_ in rows if i < 90]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames, held = [], docs
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{sf}/stage{n}.parquet"
        stage(spark, held, sf).write.parquet(out)
        held = spark.read.parquet(out)
        frames.append(held)
        if n < 4:
            assert held.columns == COLUMNS
    text = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames[:4]]

    # quality: clean documents stay, junk, null and empty ones go
    clean = {i for i, t, *_ in corpus() if t and not (i < 120 and i % 3 == 1)}
    assert set(text[0]) == clean

    # near copies: one of each group, the smallest id
    groups = brute_groups(sorted(text[0].items()), 80)
    assert set(text[1]) == {i for i, g in groups.items() if g[2]}
    assert 12 in text[1] and 200 not in text[1]

    # repeats: windows of 13 words that an earlier document has
    first, want = {}, {}
    for i, t in sorted(text[1].items()):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), i) < i:
                gone[k : k + 13] = [True] * 13
        want[i] = " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t
    assert text[2] == want and want[30] != text[1][30] and want[6] == text[1][6]

    # secrets: nothing else changes
    assert text[3] == {i: t.replace("password=hunter2222", "<secret>") for i, t in want.items()} and "<secret>" in text[3][9]
    assert all(r["n_chars"] == len(r["text"]) for r in frames[3].collect())

    # packing: every piece once, gapless, in few sequences
    tok = Tokenizer.from_file(VOCABULARY)
    ids = {i: tok.encode(t, add_special_tokens=False).ids + [0] for i, t in text[3].items()}
    pieces = frames[4].collect()
    for r in pieces:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r["ids_crc32"]
    assert sum(r["length"] for r in pieces) == sum(map(len, ids.values()))
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_run_equals_stages(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    want = spark.read.parquet(f"{sf}/stage4.parquet")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
