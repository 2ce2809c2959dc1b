"""Damage in a gzip member of many records."""

import random

from eventfares.llm import warc

N = 20


def made(seed=1):
    pick = random.Random(seed)
    return [warc.record_bytes(i, "u", pick.randbytes(pick.randrange(500, 1500)), None) for i in range(N)]


def found(data):
    return list(warc._salvage(memoryview(data)))


def ids(rows):
    return [x[3]["record_id"] for x in rows if x[0] == "record"]


def gaps(rows):
    return [x[1:] for x in rows if x[0] == "gap"]


NAMES = [warc.ID_FORMAT % i for i in range(N)]


def test_a_wrong_digest_costs_one_record():
    records = made()
    start = sum(map(len, records[:7]))
    bad = bytearray(records[7])
    bad[-20] ^= 1
    member = warc._gzip(b"".join([*records[:7], bytes(bad), *records[8:]]))
    rows = found(member)
    assert ids(rows) == NAMES[:7] + NAMES[8:]
    assert gaps(rows) == [(0, len(member), "block digest differs", start, len(bad))]


def test_a_wrong_check_sum_at_the_end_costs_no_record():
    member, after = bytearray(warc._gzip(b"".join(made()))), warc._member(warc.record_bytes(99, "u", b"x", None))
    member[-6] ^= 1
    rows = found(bytes(member) + after)
    assert ids(rows) == [*NAMES, warc.ID_FORMAT % 99]
    (gap,) = gaps(rows)
    assert gap[2] == "member does not unpack" and gap[0] + gap[1] == len(member)


def test_cut_flipped_and_missing_bytes_keep_what_comes_before(tmp_path, spark):
    records, after = made(), warc._member(warc.record_bytes(99, "u", b"x", None))
    ends = [sum(map(len, records[: k + 1])) for k in range(N)]
    member = warc._gzip(b"".join(records))
    at = len(member) * 9 // 10
    flipped = bytearray(member)
    flipped[at] ^= 0xFF
    cases = {"cut": member[:at], "flipped": bytes(flipped) + after, "missing": member[:at] + member[at + 1 :] + after}
    # Random payloads hardly shrink, so this many records end well before the fault.
    sure = sum(e < len(b"".join(records)) * 8 // 10 for e in ends)
    for name, data in cases.items():
        rows = found(data)
        names = [x for x in ids(rows) if x != warc.ID_FORMAT % 99]
        assert len(names) >= sure > 10 and names[:sure] == NAMES[:sure]
        assert (ids(rows)[-1] == warc.ID_FORMAT % 99) == (name != "cut")
        assert gaps(rows) and all(g[3] is not None for g in gaps(rows)[:1])
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    archive = warc.read_warc(spark, str(tmp_path))
    assert warc.records(archive).count() == sum(len(ids(found(d))) for d in cases.values())
    assert {r.inner_offset for r in warc.gaps(archive).collect()} >= {gaps(found(d))[0][3] for d in cases.values()}


def test_records_without_a_digest_need_a_member_that_unpacks():
    bare = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: a\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    member = warc._gzip(bare * 2)
    assert ids(found(member)) == ["a", "a"]
    broken = member[:-1]
    assert [x[:3] for x in found(broken)] == [("gap", 0, len(broken))]
