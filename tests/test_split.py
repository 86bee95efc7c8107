"""Large files read in pieces give what whole files give."""

import json
import random

import pytest
from test_sources import put

from threadloom.sources import batches as B
from threadloom.sources import split
from threadloom.sources.split import scan_batches

R = random.Random(17)
SIGNS = ["{", "}", "[", "]", '"', "\\", ",", ":", "é", "\n", "x", " ", "😀"]


def text():
    return "".join(R.choice(SIGNS) for _ in range(R.randint(0, 30)))


def post(n):
    replies = [{"id": text(), "replies": [{"body": text()}]} for _ in range(R.randint(0, 2))]
    return {"id": f"p{n}", "title": text(), "text": text() * R.choice([1, 1, 20]), "extra": {"a": [{}, {"b": text()}]}, "comments": replies}


STRAYS = [5, "a } string", ["x", {"id": "no"}], None, True, -1.5, "}", {}]


@pytest.fixture
def folder(tmp_path):
    posts = [post(n) for n in range(60)]
    mixed = [x for p in posts[:20] for x in [p, *R.sample(STRAYS, R.randint(0, 3))]]
    put(tmp_path, "plain.json", json.dumps(posts, ensure_ascii=False))
    put(tmp_path, "indent.json", "﻿\n" + json.dumps(posts[:30], indent=2) + "\n\n")
    put(tmp_path, "mixed.json", json.dumps(mixed, ensure_ascii=False))
    put(tmp_path, "strays.json", json.dumps(STRAYS[:7]))
    put(tmp_path, "lead.json", json.dumps([*STRAYS, posts[0], 7]))
    put(tmp_path, "one.json", json.dumps(posts[3]))
    put(tmp_path, "one_line.json", json.dumps({"id": "o", "x": {"y": {}}, "comments": [{"id": "c"}]}) + "\n")
    put(tmp_path, "none.json", " [ ] ")
    put(tmp_path, "blank.json", "")
    put(tmp_path, "number.json", "12")
    whole = json.dumps(posts[:9])
    broken = {
        "tail": whole + " and more", "brace": whole + "}", "twice": f"{whole},{whole}", "cut": whole[: len(whole) // 2], "comma": whole[:-1] + ",]",
        "no_comma": whole.replace('}, {"id": "p4"', '} {"id": "p4"'), "lead_comma": "[," + whole[1:], "single": "[{'id': 'q'}]", "no_end": whole[:-1],
        "two": '{"id": "a"}\n{"id": "b"}', "open_string": whole[:-1] + ', {"id": "x}]', "word": whole.replace('{"id": "p5"', 'oops {"id": "p5"'), "stray": '{"id": "a"}}',
    }
    for name, value in broken.items():
        put(tmp_path, f"broken_{name}.json", value)
    return tmp_path


def rows(parsed):
    return sorted((r.file_name, r.post_pos, sorted(r.post.items())) for r in parsed.collect())


@pytest.mark.parametrize("block", [64, 701, 128 << 20])
def test_pieces_give_what_whole_files_give(spark, folder, block):
    listed = B.list_batches(spark, str(folder))
    want = rows(B.parse_batches(B.read_files(spark, listed)))
    files = {name for name, _, _ in want}
    assert {"plain.json", "indent.json", "mixed.json", "lead.json", "one.json", "one_line.json"} <= files
    assert not any(name.startswith("broken") for name in files) and len([1 for name, _, _ in want if name == "plain.json"]) == 60
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        if block == 701:  # one file is read by many tasks
            one = spark.read.option("lineSep", "}").text(str(folder / "plain.json"))
            assert one.rdd.getNumPartitions() > 8
        assert rows(scan_batches(spark, listed, above=0)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved[0])
        spark.conf.set("spark.sql.files.openCostInBytes", saved[1])


def test_many_blocks_go_in_several_passes(spark, folder, monkeypatch):
    listed = B.list_batches(spark, str(folder)).filter("file_name LIKE 'o%' OR file_name LIKE '%i%'")
    want = rows(B.parse_batches(B.read_files(spark, listed)))
    monkeypatch.setattr(split, "BLOCKS_SENT", 2)
    assert rows(scan_batches(spark, listed, above=0)) == want
