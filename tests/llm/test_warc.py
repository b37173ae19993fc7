"""Archives: exact round trip, revisits, and salvage of damaged bytes."""

import hashlib
import random
import time

import pytest
from helpers import SAMPLE, dicts, pages
from metricloom.llm import warc
from metricloom.llm.storage import new_folder, read


def by_hand(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            payload = (html or "").encode()
            first[payload] = min(page_id, first.get(payload, page_id))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        refers = first.get(payload) if len(payload) >= 100 else None
        if refers == page_id:
            refers = None
        out.append(
            (page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if refers is not None else "response", refers)
        )
    return sorted(out, key=str)


def got(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted([tuple(r[n] for n in names) for r in dicts(df)], key=str)


def test_round_trip_of_the_sample(spark):
    table = read(spark, SAMPLE, "pages")
    rows = [(r["page_id"], r["url"], r["html"]) for r in table.collect()]
    assert got(warc.round_trip(table)) == by_hand(rows)


def test_round_trip_of_edge_pages(spark):
    long = "é<p>" * 40
    rows = [
        (5, "http://a/", long), (3, "http://b/ \r\nX: y", long), (9, None, long), (3, "http://b/2", long),
        (None, "http://c/", long), (1, "http://d/", None), (2, "http://e/", ""), (4, "x", "a" * 99),
        (6, "x", "a" * 99), (7, "x", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3),
        (8, "x", "\x00퟿\U0010ffff" * 50), (None, None, "only without ids" * 20), (None, None, "only without ids" * 20),
        (10, "x", "big " * (5 << 20)), (11, "http://h/" + "u" * 2_000_000, long + "long url"),
    ]
    assert got(warc.round_trip(pages(spark, rows))) == by_hand(rows)
    assert got(warc.round_trip(pages(spark, []))) == []


def test_payloads_come_back(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i} é</p>" * 30) for i in range(50)]
    folder = new_folder(spark, "archives")
    warc.write_archives(pages(spark, rows).selectExpr("*", "1 as digest", "2 as first"), folder, archive_bytes=2000)
    back = dicts(warc.read_archives(spark, folder))
    assert {(r["page_id"], r["url"], r["payload"].decode()) for r in back} == set(rows)
    sizes = [r["length"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()]
    assert len(sizes) >= 8 and max(sizes) < 2000 + max(map(len, archive(50, True))) + 400


def archive(n, packed):
    records = []
    for i in range(n):
        payload = f"payload {i} ".encode() * (i + 3)
        record = warc.record_bytes(i, f"http://h/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        records.append(warc.member_bytes(record) if packed else record)
    return records


def ids(found):
    return [int(x["fields"]["x-page-id"]) for _, _, x in found if isinstance(x, dict)]


def test_members_end_in_zero_and_follow_each_other():
    assert all(m[-1] == 0 for m in archive(20, True))
    assert ids(warc.salvage(b"".join(archive(20, True)))) == list(range(20))


def test_damage_costs_only_the_damaged_records():
    for packed in (True, False):
        records = archive(6, packed)
        edges = [sum(map(len, records[:i])) for i in range(7)]
        whole = b"".join(records)
        cases = {
            "flipped": (whole[: edges[3] - 9] + bytes([whole[edges[3] - 9] ^ 0x55]) + whole[edges[3] - 8 :], [0, 1, 3, 4, 5]),
            "cut": (whole[: edges[3] + 20], [0, 1, 2]),
            "junk": (whole[: edges[1]] + b"\x1f\x8b\x08 junk WARC/1.1\r\nContent-Length: x\r\n\r\n" + whole[edges[1] :], [0, 1, 2, 3, 4, 5]),
            "lost": (whole[: edges[4] - 9] + whole[edges[4] :], [0, 1, 2, 4, 5]),
            "head": (b"\x00" * 50 + whole, [0, 1, 2, 3, 4, 5]),
        }
        for name, (data, expected) in cases.items():
            found = list(warc.salvage(data))
            assert ids(found) == expected, (packed, name)
            gaps = [(s, e) for s, e, x in found if isinstance(x, str)]
            assert len(gaps) == 1 and gaps[0][0] < gaps[0][1] <= len(data), (packed, name)
            covered = sorted({(s, e) for s, e, _ in found})
            assert covered[0][0] == 0 and covered[-1][1] == len(data)
            assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))


def test_random_damage_never_gives_a_wrong_record():
    draw = random.Random(8)
    good = {i: x["payload"] for i, (_, _, x) in enumerate(warc.salvage(b"".join(archive(12, True))))}
    for packed in (True, False):
        whole = b"".join(archive(12, packed))
        for _ in range(60):
            data = bytearray(whole)
            for _ in range(draw.randint(1, 6)):
                data[draw.randrange(len(data))] = draw.randrange(256)
            for _, _, x in warc.salvage(bytes(data)):
                if isinstance(x, dict) and "x-page-id" in x["fields"]:
                    i = warc._number(x["fields"]["x-page-id"])
                    assert not packed or x["payload"] == good[i]


def test_gaps_are_rows(spark):
    folder = new_folder(spark, "archives")
    rows = [(i, f"http://h/{i}", f"page {i} " * 40) for i in range(5)]
    warc.write_archives(pages(spark, rows).coalesce(1), folder)
    [(path, data)] = [
        (r["path"], r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()
    ]
    other = new_folder(spark, "archives")
    value = spark.createDataFrame([(bytes(data[:90]) + b"??" + bytes(data[92:-1]),)], "value binary")
    value.selectExpr("cast(value as string) as value").coalesce(1).write.option("lineSep", "\0").text(other)
    with pytest.raises(warc.PagesLost, match="4 of 5 records .* 1 gaps"):
        warc.read_back(spark, other, 5)
    assert warc.read_back(spark, other, 4).count() == 4
    back = dicts(warc.read_archives(spark, other))
    gaps = [r for r in back if r["gap_reason"]]
    assert [r["gap_reason"] for r in gaps] == ["gzip"] and gaps[0]["start"] == 0
    assert len(back) == 5


def test_many_version_lines_without_a_header_end_are_read_in_linear_time():
    data = (b"WARC/1.1\r\n" + b"x" * 30) * 100_000
    began = time.monotonic()
    [(start, end, reason)] = warc.salvage(data)
    assert (start, end, reason) == (0, len(data), "header") and time.monotonic() - began < 20
