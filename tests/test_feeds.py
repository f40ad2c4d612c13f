"""The feed source: cutting records out of streams, several feeds, broken files, memory."""

import gzip
import json
import subprocess
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from secdata.operators import cwe_ladder
from secdata.sources import feeds, readers


def _cut(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)]


_VALUE = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text(st.sampled_from('ab"\\{}[]:,é '), max_size=6)), lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from(["a", "v", 'q"', "{"]), x, max_size=3)), max_leaves=8)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "v", "z"]), _VALUE, max_size=3), st.lists(st.one_of(st.dictionaries(st.sampled_from("abv"), _VALUE, max_size=3), st.integers(), st.lists(st.just({"v": 1}), max_size=2)), max_size=5), st.integers(1, 50), st.booleans())
def test_records_equal_a_whole_parse(root, items, size, spaced):
    text = json.dumps({**root, "v": items}, ensure_ascii=False, indent=1 if spaced else None).encode()
    want = [x for x in items if isinstance(x, dict)]
    assert [json.loads(r) for r in feeds.records(_cut(text, size), "v")] == want
    assert [json.loads(r) for r in feeds.records(feeds.unzipped(_cut(gzip.compress(text), size)), "v")] == want


@pytest.mark.parametrize(("text", "n"), [(b"", 0), (b"[{}]", 0), (b'{"v": {"a": [{}]}}', 0), (b'{"v": [{"a": 1}, {"b', 1), (b'{"x": [{"v": [{}]}], "v": [{"v": [{}]}]}', 1), (b"\x1f\x8bnot really", 0), (b"plain text", 0)])
def test_what_is_no_feed_gives_nothing_behind_the_break(text, n):
    for size in (1, 7, 1000):
        assert len(list(feeds.records(feeds.unzipped(_cut(text, size)), "v"))) == n


def test_members_and_broken_archives():
    text = json.dumps({"v": [{"i": i} for i in range(5000)]}).encode()
    two = gzip.compress(text[:100]) + gzip.compress(text[100:])
    assert len(list(feeds.records(feeds.unzipped(_cut(two, 64)), "v"))) == 5000
    assert 0 < len(list(feeds.records(feeds.unzipped(_cut(gzip.compress(text)[:-3000], 64)), "v"))) < 5000


def _item(cve: str, cwe: str, n: int = 0) -> dict:
    return {"cve": {"id": cve, "weaknesses": [{"type": "Primary", "description": [{"lang": "en", "value": cwe}]}], "references": [{"url": "u" * n, "tags": ["Patch"]}]}}


def test_the_last_record_over_several_feeds(spark, tmp_path):
    for year, items in {"2019": [_item("CVE-2019-0001", "CWE-1"), _item("CVE-2019-0001", "CWE-2"), _item("CVE-2019-0002", "CWE-9")], "2020": [_item("CVE-2019-0001", "CWE-3"), _item("CVE-2020-0001", "CWE-4")]}.items():
        (tmp_path / f"feed-{year}.json.gz").write_bytes(gzip.compress(json.dumps({"format": "x", "vulnerabilities": items}).encode()))
    (tmp_path / "feed-2021.json").write_text("{broken")
    rows = readers.read_nvd(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 3
    assert {r.cve: r.cwes for r in cwe_ladder.last_record(rows).collect()} == {"CVE-2019-0001": ["CWE-3"], "CVE-2019-0002": ["CWE-9"], "CVE-2020-0001": ["CWE-4"]}
    assert sorted(tuple(r.ordinal) for r in rows.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_a_feed_is_never_held_whole(tmp_path):
    path = tmp_path / "big.json.gz"
    with gzip.open(path, "wb", 1) as f:
        f.write(b'{"vulnerabilities": [')
        for i in range(30_000):
            f.write((b"," if i else b"") + json.dumps(_item(f"CVE-2020-{i:04}", "CWE-1", 5000)).encode())
        f.write(b"]}")  # 150 MB of text
    code = f"""
import resource
from secdata.sources import feeds
reader = feeds._Reader({{"paths": '["file://{path}"]', "array": "vulnerabilities"}})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    n, grown = map(int, subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env={"PYTHONPATH": ":".join(sys.path)}).stdout.split())
    assert n == 30_000 and grown < 100, f"{grown} MB more"
