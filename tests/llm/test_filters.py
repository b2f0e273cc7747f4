import re

from pyspark.sql import functions as F

from wayline.llm import license_scan, url_filter
from wayline.llm.queries import RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scan_by_hand(text, templates):
    words = re.findall(license_scan.WORD, (text or "").translate(LOWER))
    matches = []
    for start in range(0, max(1, len(words)), license_scan.STRIDE):
        block = words[start : start + license_scan.BLOCK]
        for t in templates:
            both = len(set(t.words) & set(block))
            if both < t.needed:
                continue
            n = len(t.words)
            places = [start + k for k in range(min(license_scan.STRIDE, len(block) - n + 1)) if tuple(block[k : k + n]) == t.words]
            if places or not t.phrase:
                matches.append((t.label, both / len(set(t.words)), start, places if t.phrase else None))
    return len(words), sorted(matches, key=repr)


def test_license_scan_equals_plain_search(spark, odd_docs, empty_docs):
    parts = ["mit", "license", "apache", "the", "general public license", "licensed under the", "version 2 0", "released under", "word", "x"]
    texts = [" ".join(parts[(i * k * k + k * 3 + i) % len(parts)] for k in range(i * 2)) for i in range(60)]
    made = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(made)
    found = license_scan.license_scan(docs)
    got = sorted(((r.id, r.n_words, sorted(((m.label, m.containment, m.start, m.places) for m in r.matches), key=repr)) for r in found.collect()), key=repr)
    expected = sorted(((r.doc_id, *scan_by_hand(r.text, license_scan.TEMPLATES)) for r in docs.collect()), key=repr)
    assert got == expected
    assert license_scan.license_scan(empty_docs).collect() == []


def test_license_summary_counts_all_places(spark):
    text = "MIT license " * 100 + "x " * 7 + "general public license"
    row = license_scan.summary(license_scan.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_base, row.first_word, row.last_word, row.base_labels, row.score) == (101, 0, 207, "gpl,mit", 1.0)


def verdict_by_hand(url, rules, listed):
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3 :]
    raw = re.match("[^/?#]*", rest).group()
    host, path = raw.translate(LOWER), re.match("[^?#]*", rest[len(raw) :]).group()
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if host + path in listed else "allow"


URLS = [
    "http://A.Example.NET/en/1?x=/de/", "https://example.net/en", "http://net/", "http://internet/", "x://sub.net", "http://m.example.com/de/#a",
    "http://example.com/DE/", "http://b.org/fr/a/b", "http://b.org/frx", "no scheme", "", None, "://", "ftp://h.com/p?q", "http://h.com/p#z",
    "http://h.com/" + "p" * 5000, "http://.net/", "http://a..net//", "HTTP://É.net/", "http://a.org:80/fr/", "x://y://net/",
]


def test_url_verdicts(spark):
    rows = [(i, u, "c", 1, "k") for i, u in enumerate(URLS)] + [(None, URLS[0], "c", 1, "k"), (0, URLS[0], "c", 1, "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, row long, key string")
    listed = ["h.com/p", "b.org/frx", "b.org/frx", None, "é.net/"]
    found = url_filter.url_verdicts(
        pages, spark.createDataFrame(RULES, "host string, path string, verdict string"),
        spark.createDataFrame([(u,) for u in listed], "url string"),
    )
    got = sorted(((r.id, r.host, r.path, r.rule, r.verdict) for r in found.collect()), key=repr)
    assert got == sorted(((r[0], *verdict_by_hand(r[1], RULES, set(listed))) for r in rows), key=repr)


def test_url_verdicts_on_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules, listed = spark.createDataFrame([], "host string, path string, verdict string"), spark.createDataFrame([], "url string")
    assert [tuple(r) for r in url_filter.url_verdicts(pages, rules, listed).collect()] == [(1, "a.net", "/", None, "allow", False)]
    assert url_filter.url_verdicts(pages.limit(0), rules, listed).collect() == []


def test_bloom_filter_has_no_false_negatives_and_few_hits(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    bits = url_filter.bloom_filter(keys, "key", 256).scalar()
    tried = spark.range(6000).select("id", F.concat(F.lit("k"), "id").alias("key"), bits.alias("bits"))
    hits = {r.id for r in tried.filter(url_filter.might_contain(F.col("key"), F.col("bits"), 256)).collect()}
    assert set(range(2000)) <= hits and len(hits) < 2600
