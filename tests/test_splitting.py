"""JSON arrays and logs cut into many blocks give the rows of a reader that sees them whole."""

import json
import random

import pytest

from ledgerline.sources import splitting
from ledgerline.sources.splitting import ESCAPED, INSIDE, OUTSIDE, read_json_array, read_numbered_lines, walk

SCHEMA = "id bigint, name string, tags array<string>, inner struct<a: string, deep: array<struct<b: int>>>"


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward(n, seed, long=0):
    rng = random.Random(seed)
    bits = ["}", "{", "],[", '"', "\\", '\\"', "},{", "é", "\n", "a", ", ", "]}", "\\\\"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))
    out = []
    for i in range(n):
        row = {"id": i, "name": text(), "tags": [text() for _ in range(rng.randrange(3))], "extra": {"x": [{"y": text()}]}}
        if rng.random() < 0.5:
            row["inner"] = {"a": text(), "deep": [{"b": k} for k in range(rng.randrange(3))]}
        if long and i % 97 == 5:
            row["name"] = "}{" * long
        out.append(row)
    return out


def rows_of(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("indent", [None, 2])
def test_array_equals_the_whole_reader(spark, tmp_path, small_blocks, indent):
    path = str(tmp_path / "a.json")
    with open(path, "w") as f:
        json.dump(awkward(900, 1, long=7000), f, indent=indent, ensure_ascii=False)
    parts = read_json_array(spark, path, SCHEMA)
    whole = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    assert rows_of(parts) == rows_of(whole) and parts.count() == 900
    pieces = splitting._pieces(spark, path, "}", {})
    assert pieces.rdd.getNumPartitions() > 20 and pieces.select("block").distinct().count() > 20


def test_many_files_and_empty_ones(spark, tmp_path, small_blocks):
    for i, text in enumerate([json.dumps(awkward(300, 2)), "[]", "", " [ \n ] \n", "\ufeff" + json.dumps(awkward(40, 3))]):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    assert len(rows_of(read_json_array(spark, str(tmp_path), SCHEMA))) == 340


def plain_walk(text, state):
    depth = 0
    for c in text:
        if state == ESCAPED:
            state = INSIDE
        elif state == INSIDE:
            state = ESCAPED if c == "\\" else OUTSIDE if c == '"' else INSIDE
        elif c == '"':
            state = INSIDE
        else:
            depth += (c in "{[") - (c in "}]")
    return state, depth


def test_walk_is_the_plain_automaton():
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choice('"\\{}[]a\n') for _ in range(rng.randrange(0, 14)))
        for state in range(3):
            assert walk(text, state) == plain_walk(text, state), (text, state)


def test_changed_blocks_are_noticed(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(awkward(5, 4)))
    cut = splitting._pieces(spark, str(tmp_path), "}", {}).mapInArrow(splitting._records({}), "file string, block long, seq long, owner long, text string")
    with pytest.raises(Exception, match="read again"):
        cut.count()


def test_numbered_lines(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    texts = {}
    for name in ("a.log", "b.log", "c.log"):
        lines = ["x" * rng.randrange(0, 90) + str(i) for i in range(0 if name == "c.log" else 1200)]
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name == "a.log" and lines else ""))
        texts[name] = lines
    got = {}
    for r in read_numbered_lines(spark, str(tmp_path)).collect():
        got.setdefault(r.file.rsplit("/", 1)[-1], {})[r.line_no] = r.line
    for name, lines in texts.items():
        assert got.get(name, {}) == dict(enumerate(lines, 1))
