"""Line chunks, URL rules, decontamination and the pipeline: small cases and brute force."""

import re
import time

import numpy as np
import pytest

import corpus_pipeline
from rollsight.llm import catalog, decontaminate, line_chunks, url_rules
from tests.llm.rows import LINES, empty_documents, odd_documents


def rows_by_id(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r["doc_id"], []).append(r)
    return found


def test_line_chunks_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = line_chunks.without_repeats(docs, counts=("all_lines", "gone"))
    assert got.columns == [*docs.columns, "all_lines", "gone"] and got.count() == docs.count()
    by = rows_by_id(got)
    assert by[8][0]["text"] == LINES and by[8][0]["gone"] == 0
    assert by[9][0]["gone"] >= 6 and by[9][0]["text"].startswith("before") and by[9][0]["text"].endswith("after")
    assert by[9][0]["n_chars"] == len(by[9][0]["text"]) and by[9][0]["start"] == 2
    assert by[3][0]["text"] is None and by[4][0]["text"] == "" and by[3][0]["all_lines"] == 0
    assert [r["text"] for r in by[1]] == [by[2][0]["text"]] * 2
    assert line_chunks.without_repeats(empty_documents(spark)).count() == 0


def test_long_lines_and_copies(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    texts = [(1, f"one\n{passage}\ntwo"), (2, f"three\n{passage}\nfour"), (3, passage), (4, "short\nline"), (5, "short\nend")]
    by = rows_by_id(line_chunks.without_repeats(odd_documents(spark, texts)))
    assert [by[k][0]["text"] for k in range(1, 6)] == [texts[0][1], "three\nfour", "", "short\nline", "short\nend"]


def test_equal_hashes_of_unlike_bytes_stay(spark, monkeypatch):
    """Chunks that only share a key are kept: here every key is the same."""
    real = line_chunks.chunks
    monkeypatch.setattr(line_chunks, "chunks", lambda docs, n: real(docs, n).selectExpr("owner_id", "content", "start", "stop", "'k' AS chunk"))
    docs = odd_documents(spark, [(1, "a\nb"), (2, "c\nd")])
    assert sorted(r["text"] for r in line_chunks.without_repeats(docs).collect()) == ["a\nb", "c\nd"]


def plain_verdict(url, rules):
    at = -1 if url is None else url.find("://")
    host = path = ""
    if at >= 0:
        host = re.match(r"[^/?#]*", url[at + 3:]).group()
        path = re.match(r"[^?#]*", url[at + 3 + len(host):]).group()
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme/en/", "http://a.example.NET/en/1", "http://example.net", "http://example.net/en", "http://x.net?a=/en/",
    "http://notexample.com/de/", "https://example.com/de/#x", "ftp://É.org/fr/é", "http://net/", "http://org/fr/", "://example.com/de/",
    "http://example.com./de/", "http://a..net//", "http://u:p@x.net:80/", "http://x.net/" + "p/" * 5000, "http://a://b.org/fr/",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k % 7, u, "h", "r") for k, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string")
    rules = [*url_rules.RULES, ("example.com", "", "allow"), (None, "/", "block"), ("b.org", "/fr/x", "block")]
    got = url_rules.judged(pages, url_rules.rule_table(spark, [r for r in rules if r[0]])).collect()
    assert len(got) == len(URLS) * 2
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"], [x for x in rules if x[0]])
    assert url_rules.judged(pages.limit(0), url_rules.rule_table(spark)).count() == 0
    none = url_rules.judged(pages, url_rules.rule_table(spark).limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and {r["rule"] for r in none} == {None}


def plain_words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items):
    words = plain_words(text)
    hit, named = set(), set()
    for item, question in items:
        w = plain_words(question)
        for i in range(max(1, len(w) - 12) if w else 0):
            win = w[i:i + 13]
            for k in range(len(words) - len(win) + 1):
                if words[k:k + len(win)] == win:
                    hit.update(range(k, k + len(win)))
                    named.add(str(item))
    return len(words), len(hit), sorted(named)


QUESTION = "What is the 1st rule of Émile's long question, and who — after all — asked it at first?"
ITEMS = [(1, QUESTION), (2, "short one"), (3, None), (4, "..."), (10, QUESTION + " More words follow here")]
ASKED = [
    (1, "Intro. " + QUESTION.upper() + " End"), (2, "a Short-one and short ones"), (3, None), (4, ""), (5, "what is the 1st rule of emile"),
    (6, "short one " + "pad " * 60), (7, "x" * 10_000), (8, QUESTION + " " + QUESTION), (8, QUESTION + " " + QUESTION),
]


def test_url_rules_on_hosts_of_many_labels(spark):
    rules = [*url_rules.RULES, ("a.b.example.net", "/en/x", "block"), ("b.example.net.", "/", "block")]
    tail = ["a.b.example.net/en/x1", "b.example.net/en/", "example.net", "net/q", "b.example.net./", "org/fr/", "example.com/fr/"]
    urls = [f"http://{'x.' * 100_000}{rest}" for rest in tail] + [f"http://{'.' * 50_000}net/", f"http://{'net' * 30_000}/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    start = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judged(pages, url_rules.rule_table(spark, rules)).collect()}
    assert time.time() - start < 20
    assert got == {
        0: ("a.b.example.net/en/x", "block"), 1: ("example.net/en/", "allow"), 2: (None, "allow"), 3: ("net/", "block"),
        4: ("b.example.net./", "block"), 5: ("org/fr/", "allow"), 6: (None, "allow"), 7: ("net/", "block"), 8: (None, "allow"),
    }


@pytest.mark.parametrize("size", [500_000, 2])
def test_decontamination(spark, monkeypatch, size):
    """A tiny automaton size makes several scans of it."""
    monkeypatch.setattr(decontaminate, "AUTOMATON_WINDOWS", size)
    docs = odd_documents(spark, ASKED)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.marked(docs, bench).collect()
    assert len(got) == len(ASKED)
    for r in got:
        n, hit, named = plain_hits(r["text"], ITEMS)
        assert (r["found"]["n_words"], r["found"]["n_hit"], r["found"]["items"]) == (n, hit, named), r["doc_id"]
        covered = " ".join(r["text"][s["start"]:s["end"]] for s in r["found"]["spans"]) if r["text"] else ""
        assert len(decontaminate.words_of(covered)) == hit
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 7]
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(ASKED)
    assert decontaminate.clean(empty_documents(spark), bench).count() == 0


def test_pipeline_stages(spark):
    """Each stage against its own input; what is rejected goes, clean documents stay."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    columns, frames = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], folder).cache())
    assert all(f.columns == columns for f in frames[:5])
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = ids[0] - ids[1]
    assert sum(toxic.get(d, 0) for d in gone) >= 0.8 * sum(toxic.get(d, 0) for d in ids[0])
    assert sum(toxic.get(d, 1) == 0 for d in gone) <= 0.02 * len(ids[0])
    assert ids[2] == ids[1]
    from tests.llm.test_resemblance import plain_kept

    texts = {r["doc_id"]: r["text"] for r in frames[2].select("doc_id", "text").collect()}
    assert ids[3] == plain_kept(texts)
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = set()
    for doc in ids[3]:
        n, hit, _ = plain_hits(texts[doc], bench) if any(q[:25].lower() in texts[doc].lower() for _, q in bench) else (1, 0, [])
        if hit and 20 * hit >= n:
            dirty.add(doc)
    assert ids[4] <= ids[3] and dirty <= ids[3] - ids[4]
    assert ids[5] == ids[4]
    run = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).select("doc_id").collect()}
    assert run == ids[5]
    assert "pipeline" not in catalog.QUERIES


def words(draw, n):
    return " ".join(f"w{k}" for k in draw.integers(0, 10**9, n))


@pytest.mark.parametrize("lines", [3, 5, 8])
def test_planted_passages_leave_wholly(spark, lines):
    """Passages of lines of 1 to 24 words, over 50 in all, between other lines; copies keep only the other lines."""
    draw, texts, left = np.random.default_rng(lines), [], {}
    for k in range(30):
        while True:
            passage = [words(draw, int(n)) for n in draw.integers(1, 25, lines)]
            if sum(len(p.split()) for p in passage) > 50:
                break
        for copy in range(3):
            around = [words(draw, int(n)) for n in draw.integers(1, 25, 8)]
            inner = list(passage)
            if copy == 2:
                inner.insert(1, " \t")
            doc = copy * 100 + k
            texts.append((doc, "\n".join(around[:4] + inner + around[4:])))
            left[doc] = texts[-1][1] if copy == 0 else "\n".join(around)
    got = {r["doc_id"]: r["text"] for r in line_chunks.without_repeats(odd_documents(spark, texts)).collect()}
    assert got == left


def test_first_places_and_short_repeats_stay(spark):
    """A line that repeats in one text keeps its first place; 50 words in runs without a whole chunk stay."""
    draw = np.random.default_rng(0)
    line, pair = words(draw, 20), [words(draw, 24) for _ in range(2)]
    texts = [(1, "\n".join([line] * 9)), (2, "\n".join(["one", *pair, "two"])), (3, "\n".join(["six", *pair, "ten"]))]
    by = rows_by_id(line_chunks.without_repeats(odd_documents(spark, texts), counts=("all", "gone")))
    assert by[1][0]["text"] == line and (by[1][0]["all"], by[1][0]["gone"]) == (9, 8)
    assert all(by[k][0]["text"].split("\n")[::3] == texts[k - 1][1].split("\n")[::3] for k in (2, 3))


def test_a_text_of_many_short_lines(spark):
    text = "\n".join(f"line {k}" if k % 3 else "" for k in range(60_000))
    by = rows_by_id(line_chunks.without_repeats(odd_documents(spark, [(1, text), (2, "new\n" + text)])))
    assert by[1][0]["text"] == text and by[2][0]["text"].strip() == "new"
