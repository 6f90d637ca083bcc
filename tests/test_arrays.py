"""JSON arrays by byte ranges, and written as ranges, against the json library."""

import json
import random

import pytest

from lodestrata.sources import arrays, records

ODD = ["plain", 'a "quote" and \\ and \\" too', "br[ac]k{et}s, \\\\", "}}}]]],,,{{{", "é終\U0001f600", "\n\t", "", "{", "]", "\\"]


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind >= 5:
        return {rng.choice(ODD) + str(i): value(rng, depth + 1) for i in range(rng.randrange(4))}
    return (rng.choice(ODD), rng.randrange(10**6), None, rng.random() < 0.5)[kind]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "67b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_elements_of_files_in_small_splits(small_splits, tmp_path):
    spark, rng = small_splits, random.Random(4)
    held = {f"f{i}": [value(rng) for _ in range(rng.choice((0, 1, 5, 12)))] for i in range(8)}
    for n, (name, items) in enumerate(held.items()):
        text = json.dumps(items, indent=[None, 2][n % 2], ensure_ascii=n % 3 == 0, separators=(",", ":") if n % 4 == 0 else None)
        (tmp_path / name).write_text("  \n" * (n % 2) + text + "\n" * (n % 3), encoding="utf-8")
    whole = json.dumps([{"a": 1}, {"b": "x" * 200}, {"c": [1, 2]}])
    broken = {"cut": whole[:-4], "cut2": whole[:-1], "more": whole + "]", "after": whole + " x", "before": "x " + whole, "quote": whole[:-1] + ',"]', "two": whole + whole, "open": "[", "none": "   "}
    other = {"object": '{"a": [1, 2], "b": {"c": 3}}', "number": "12", "string": '"[1, 2]"'}
    for name, text in (broken | other).items():
        (tmp_path / name).write_text(text)
    elements, files = arrays.array_elements(spark, [str(p) for p in sorted(tmp_path.iterdir())])
    found = {r.path.rpartition("/")[2]: (r.array, r.sound) for r in files.collect()}
    assert {n for n, (array, sound) in found.items() if array and sound} == set(held)
    assert {n for n, (array, _) in found.items() if not array} <= {*other, "none", "before"}
    got = {name: [] for name in held}
    for r in sorted(elements.collect(), key=lambda r: r.pos):
        name = r.path.rpartition("/")[2]
        if name in held:
            assert r.pos == len(got[name])
            got[name].append(json.loads(r.body))
    assert got == held


def test_releases_equal_the_whole_file_reader(small_splits, tmp_path):
    spark, rng = small_splits, random.Random(5)
    rows = [{"artist": rng.choice(ODD), "track_or_project_title": f"t{i}", "open_graph": {"k": rng.choice(ODD)}, "embedded_music_links": ["}", "{"], "release_article": rng.random() < 0.8} for i in range(12)]
    (tmp_path / "a.json").write_text(json.dumps([*rows, 5, "x", [rows[0]], None], indent=2))
    (tmp_path / "b.json").write_text(json.dumps(rows[:7]) + " trailing")
    (tmp_path / "c.json").write_text('[{"artist": "x"}, {"artist": nonsense}]')
    got = records.release_arrays(spark, [str(tmp_path / n) for n in ("a.json", "b.json", "c.json")]).orderBy("load_ordinal").collect()
    want = [r for r in rows if r["release_article"]]
    assert [(r.artist, r.track_or_project_title, r.open_graph, r.embedded_music_links) for r in got] == [(r["artist"], r["track_or_project_title"], r["open_graph"], r["embedded_music_links"]) for r in want]
    assert [r.load_ordinal for r in got] == [i for i, r in enumerate(rows) if r["release_article"]]
    for bad in ("b.json", "c.json"):
        with pytest.raises(ValueError, match="malformed"):
            records.release_arrays(spark, [str(tmp_path / bad)], "FAILFAST")


def test_written_ranges_are_one_array(spark, tmp_path):
    rows = [(i * 7 % 50, f'v{i}"', [i], {"k": i}) for i in range(50)]
    df = spark.createDataFrame(rows, "o int, t string, l array<int>, m map<string,int>").repartition(4)
    arrays.write_array(df, str(tmp_path / "j"), ["o"], ("o",))
    parts = sorted((tmp_path / "j").glob("part*"))
    text = "".join(p.read_text() for p in parts)
    assert len(parts) > 1 and text.endswith("]\n")
    assert json.loads(text) == [{"t": t, "l": x, "m": m} for _, t, x, m in sorted(rows, key=lambda r: r[0])]
    arrays.write_array(df.limit(0), str(tmp_path / "e"), ["o"])
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "e").glob("part*")))) == []
