import gzip
import os

from editlens.sources import raw_inventory, scan_jsonl, scan_jsonl_strict
from editlens.sources.jsonl import record_counts_jsonl

LINES = [
    '{"wiki": "enwiki", "title": "Good", "type": "edit", "bot": false, "timestamp": 1721000001}',
    '{"wiki": "enwiki", "title": "StrBot", "bot": "true", "timestamp": 1721000002}',
    '{"wiki": "enwiki", "title": "IntBot", "bot": 1, "timestamp": 1721000003}',
    '{"wiki": "dewiki", "title": "Frac", "timestamp": 1.7}',
    '{bad json',
    '',
    '{"wiki": 42, "title": "NumericWiki", "timestamp": 1721000005}',
    '{"wiki": "frwiki", "wiki": "eswiki", "title": "Dup", "timestamp": 1721000006}',
    '{"type": "Feature", "id": "us7000abcd"}',
]


def write(tmp_dir, name="part-0.jsonl"):
    p = os.path.join(tmp_dir, "2024", "07", "14", "23")
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as f:
        f.write("\n".join(LINES) + "\n")
    return tmp_dir


def test_every_file_is_read_whatever_its_name(spark, tmp_dir):
    for name, n in (("a.jsonl", 2), ("part-0000", 3), ("b.txt", 4)):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("".join(f'{{"wiki": "{name}", "id": "{i}"}}\n' for i in range(n)))
    with gzip.open(os.path.join(tmp_dir, "c.jsonl.gz"), "wt") as f:
        f.write('{"wiki": "gz"}\n' * 5)
    assert scan_jsonl(spark, tmp_dir, recursive=True).count() == scan_jsonl(spark, tmp_dir).count() == 14
    assert scan_jsonl_strict(spark, tmp_dir).count() == 7         # by name: jsonl, jsonl.gz
    assert raw_inventory(spark, tmp_dir).first().objects == 4


def test_strict_wants_exactly_one_object(spark, tmp_dir):
    lines = ['{"id": "ok", "bot": "x"}', '{"id": "t"} xyz', '{"id": "a"}{"id": "b"}', '{"id": "a"}, {"id": "b"}', '{"id": "a"}}',
             '{"id": "a"}], [{"id": "b"}', '{"id": "a"}]', '[{"id": "a"}]', '{"id": "a"', '"x"', '{}', '  {"id": "padded"}  ']
    with open(os.path.join(tmp_dir, "x.json"), "w") as f:
        f.write("\n".join(lines))
    got = [(r.id, r.bot) for r in scan_jsonl_strict(spark, tmp_dir).collect()]
    assert got == [("ok", None), (None, None), ("padded", None)]


def test_permissive_counts_malformed_but_keeps_rows(spark, tmp_dir):
    path = write(tmp_dir)
    df = scan_jsonl(spark, path, recursive=True, keep_corrupt=True)
    r = record_counts_jsonl(df).first()
    assert r.total == 8            # blank line is not a record
    assert r.malformed >= 1        # '{bad json' (type-mismatch rows may also be flagged)
    rows = {x.title: x for x in df.collect() if x.title}
    assert rows["NumericWiki"].wiki == "42"
    assert rows["Dup"].wiki == "eswiki"


def test_strict_drops_only_unparsable_lines(spark, tmp_dir):
    path = write(tmp_dir)
    df = scan_jsonl_strict(spark, path)
    titles = sorted(r.title for r in df.collect() if r.title)
    assert titles == ["Dup", "Frac", "Good", "IntBot", "NumericWiki", "StrBot"]
    assert df.count() == 7                      # + the feature without wiki/title
    bots = {r.title: r.bot for r in df.collect() if r.title}
    assert bots["StrBot"] is None and bots["Good"] is False
