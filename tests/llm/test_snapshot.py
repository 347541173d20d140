"""Operator 2: batches against a stored snapshot, in plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from sheetmill.llm.exact_dedup import dedup_batch, write_snapshot

SCHEMA = "doc_id long, text string, digest string, norm string, n string"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def stands(members):
    return min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]


def plain(snapshot, batch):
    known, groups = defaultdict(list), defaultdict(list)
    for r in snapshot:
        known[norm(r[1])].append(r)
    for r in batch:
        groups[norm(r[1])].append(r)
    out = []
    for text, members in groups.items():
        if text in known:
            out += [(r[0], True, stands(known[text]), False) for r in members]
            continue
        first, kept = stands(members), False
        for r in sorted(members, key=lambda r: -len(r[1] or "")):
            stays = r[0] == first and not kept
            kept |= stays
            out.append((r[0], False, first, stays))
    return Counter(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


SNAPSHOT = [(1, "a b"), (2, "ab "), (3, "x"), (4, None), (5, " \n"), (None, "only"), (7, "long " * 4000), (8, "c"), (8, "c")]
FIRST = [(11, "ab"), (12, "new"), (13, "n e w"), (13, "n e w"), (14, ""), (15, "onl y"), (None, "fresh"), (16, "long" * 4000)]
SECOND = [(21, "new"), (22, "X"), (23, None), (None, None), (24, "c\t")] + [(100 + i, "hot copy") for i in range(300)]


def test_batches_meet_one_stored_snapshot(spark, tmp_path):
    path = tmp_path / "snapshot"
    write_snapshot(table(spark, SNAPSHOT).repartition(3), str(path), bucket_rows=2)
    stored = {p: p.stat().st_mtime_ns for p in path.rglob("*") if p.is_file()}
    for batch in (FIRST, SECOND, []):
        got = dedup_batch(table(spark, batch), str(path))
        assert got.columns == ["doc_id", "in_snapshot", "keep_id", "kept"]
        assert Counter(map(tuple, got.collect())) == plain(SNAPSHOT, batch)
    assert {p: p.stat().st_mtime_ns for p in path.rglob("*") if p.is_file()} == stored


def test_given_documents(spark, small, tmp_path):
    old, new = small.where("doc_id % 3 <> 0"), small.where("doc_id % 3 = 0")
    write_snapshot(old, str(tmp_path / "s"))
    got = Counter(map(tuple, dedup_batch(new, str(tmp_path / "s")).collect()))
    rows = [[(r.doc_id, r.text) for r in df.collect()] for df in (old, new)]
    assert got == plain(*rows)
    assert any(known for _, known, _, _ in got)


@pytest.mark.parametrize("batch", [[], FIRST])
def test_an_empty_snapshot_knows_nothing(spark, tmp_path, batch):
    write_snapshot(table(spark, []), str(tmp_path / "s"))
    assert Counter(map(tuple, dedup_batch(table(spark, batch), str(tmp_path / "s")).collect())) == plain([], batch)
