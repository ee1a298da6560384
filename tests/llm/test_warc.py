import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabml.llm import queries, warc

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=1000):
    largest, copies = {}, Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            copies[body] += 1
            largest[body] = max(largest.get(body, -1), -1 if page is None else page)
    out = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        first = largest.get(body, -1)
        again = copies[body] > 1 and first >= 0 and page != first
        out[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    return out


def found(index):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return Counter(tuple(r[c] for c in names) for r in index.collect())


def captured(pages):
    return F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0)) % 7)


def odd_pages():
    rng = random.Random(3)
    big = "<p>" + "word " * 300 + "</p>"
    rows = [(i, f"http://www.host{i % 5}.example.com/p/{rng.randint(0, 9)}", f"<p>{rng.random()}</p>" * rng.randint(1, 60)) for i in range(60)]
    rows += [(70, "http://a.example/x", big), (71, "http://a.example/x", big), (71, "http://a.example/x", big), (72, None, big)]
    rows += [(None, "http://a.example/y", big), (None, None, None), (73, "", ""), (74, "no scheme/Path", None)]
    rows += [(75, "http://b.example/\r\nWARC/1.1", "short copy"), (76, "http://b.example/", "short copy")]
    for k, text in enumerate(["WARC/1.1\r\n", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "x\r\n\r\nWARC/1.1", "\r\n\r\n", "a\r\n", "\n\n\r\n\r\n", "WARC\r\n9\r\n/1.1 WARC/1.1", "é😀 \x85 \x1c"]):
        rows.append((80 + k, f"http://c.example/{k}", text))
        rows.append((90 + k, f"http://c.example/{k}", text * 400))
        rows.append((100 + k, f"http://c.example/{k}", text * 400))
    rows.append((120, "http://d.example/", "long " * 200_000))
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(odd_pages(), SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in ("page", "row", "digest", "payload", "captured", "value", "archive", "run")})


@pytest.mark.parametrize("split", ["64m", "700"])
def test_round_trip(spark, pages, tmp_path, split):
    path = warc.write_archives(pages.repartition(4), captured(pages), str(tmp_path / "w"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        runs = warc.capture_runs(spark, path)
        index = warc.merged_index(runs)
        rows = index.collect()
        assert found(index) == expected(odd_pages())
        payloads = Counter((r["page_id"], r["payload"]) for r in warc.payloads(spark, path).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(r["intact"] for r in rows)
    responses = Counter(k[0] for k in expected(odd_pages()).elements() if k[3] == "response")
    assert Counter(k for k, _ in payloads.elements()) == responses
    texts = defaultdict(set)
    for page, _, html in odd_pages():
        texts[page].add(html or "")
    assert all(body in texts[page] for page, body in payloads)
    keys = [warc._order(r.asDict()) for r in rows]
    assert keys == sorted(keys)  # the whole index, over all ranges, in order


def test_archives_are_valid_records(spark, pages, tmp_path):
    path = warc.write_archives(pages.coalesce(1), captured(pages), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    data, n = file.read_bytes(), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        size = int(dict(line.split(b": ", 1) for line in lines[1:])[b"Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        data, n = rest[size + 4 :], n + 1
    assert n == len(odd_pages())


def test_empty_table(spark, pages, tmp_path):
    path = warc.write_archives(pages.limit(0), captured(pages), str(tmp_path / "w"))
    assert warc.merged_index(warc.capture_runs(spark, path)).collect() == []


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert found(queries.op7_warc_index(spark, sf)) == expected(rows)


def test_loser_tree_merges_any_runs():
    rng = random.Random(8)
    for k in range(0, 20):
        runs = [sorted((rng.randint(0, 30), i, j) for j in range(rng.randint(0, 9))) for i in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_damage_is_noticed():
    record = b"WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 42\r\n\r\n"
    capture, body = warc.parsed(record + b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nbody")
    assert not capture["intact"] and body == b"body"


def test_url_keys():
    assert warc.url_key("https://u@WWW.News.Example.com:80/A/b?q=1#top") == "com,example,news)/a/b?q=1"
    assert warc.url_key(None) == warc.url_key("") == ""
