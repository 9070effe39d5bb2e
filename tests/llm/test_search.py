"""SimHash, URL rules, decontamination, sketches and personal data against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from boxweave.llm import decontam, pii, simhash, sketch, urlrules


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Breadth-first over all pairs of fingerprints within two bits."""
    left, root = set(prints.values()), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            near = {f for f in left if (f ^ todo[-1]).bit_count() <= 2}
            todo.pop()
            left -= near
            group |= near
            todo += near
        least = min((d for d, f in prints.items() if f in group and d is not None), default=None)
        root |= {f: least for f in group}
    return root


def test_fingerprints_and_components(odd, documents):
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    prints = {k: plain_fingerprint(t) for k, t in rows}
    root = plain_components(prints)
    got = simhash.components(documents).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.fp & (1 << 64) - 1 == prints[r.doc_id] and r.component_id == root[prints[r.doc_id]]
    zero = [r for r in simhash.components(odd).collect() if r.fp == 0]
    assert {r.doc_id for r in zero} == {2, 3} and {r.component_id for r in zero} == {2}


def test_crowded_points_are_refined(spark, monkeypatch):
    source, prints = random.Random(3), {}
    for _ in range(4):
        base = source.getrandbits(64)
        for _ in range(120):
            x = base
            for _ in range(source.randint(0, 5)):
                x ^= 1 << source.randrange(64)
            prints[len(prints)] = x
    prints |= {900: 0, 901: 1, 902: 2**64 - 1}
    rows = [(k, f - (1 << 64) if f >> 63 else f) for k, f in prints.items()]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs.select("doc_id", "fp"))
    root = plain_components(prints)
    table = spark.createDataFrame(rows, "doc_id long, fp long")
    for crowd in (4, 16):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        for r in simhash.components(table).collect():
            assert r.component_id == root[prints[r.doc_id]]


def test_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(3, long), (1, long), (1, long), (2, "other text of its own"), (None, "no id"), (None, long)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text[:5]) for r in kept) == [(0, "no id"), (0, "w0 w1"), (1, "w0 w1"), (2, "other")]


def test_url_rules(spark):
    urls = ["http://A.example.org/es/1?q", "https://example.org/en/1", "x://org", "a://org/", None, "no scheme", "s://b.com/fr/x#y", "s://b.com/de/", "s://c.net/", "s://example.org:80/es/", "s://EXAMPLE.ORG/es/é?/", "s://xexample.org/es/", "s://com/de/"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls * 3)], "page_id long, url string, rule string, key string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("com", "/de/", "block")]
    got = urlrules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls) * 3
    for r in got:
        url = urls[r.page_id % len(urls)] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, "allow"))
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert urlrules.judge(pages, empty).where("rule is null and verdict = 'allow'").count() == len(got)
    assert urlrules.judge(pages.limit(0), empty).count() == 0


def test_a_hot_url_is_spread_over_ranges(spark):
    pages = spark.range(2000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "s://a.org/x").otherwise(F.concat(F.lit("s://h"), "id", F.lit(".org/"))).alias("url"))
    rules = spark.createDataFrame([("a.org", "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    got = urlrules.judge(pages, rules)
    assert {(r.verdict, r.n) for r in got.groupBy("verdict").agg(F.count("*").alias("n")).collect()} == {("block", 1333), ("allow", 667)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        last, row[0] = row[0], row[0] + 1
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_alignment_against_all_stretches():
    source = random.Random(4)
    for _ in range(300):
        a = [source.randrange(4) for _ in range(source.randint(1, 7))]
        b = [source.randrange(4) for _ in range(source.randint(0, 9))]
        best = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        d, i, j = decontam.best_place(np.array(a), np.array(b, np.int64))
        assert d == best == distance(a, b[i:j])


def test_edited_items_are_found_and_clean_texts_left_alone(spark):
    source = random.Random(5)
    items = [(i, " ".join(f"v{source.randrange(300)}" for _ in range(source.randint(8, 60)))) for i in range(40)] + [(90, None), (91, ""), (92, "v1 v2")]
    docs, want = [], {}
    for d in range(200):
        i, item = items[source.randrange(40)]
        words = item.split()
        for _ in range(source.randint(0, decontam.allowed(len(words)))):
            words[source.randrange(len(words))] = "zz"
        own = [f"u{source.randrange(300)}" for _ in range(source.randint(0, 200))]
        docs.append((d, " ".join(own + ["V0,"] + words + own)))
        want[d] = i
    docs += [(500 + d, " ".join(f"u{source.randrange(300)}" for _ in range(50))) for d in range(50)] + [(None, None), (700, "")]
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, start string")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    got = decontam.matches(table, bench).collect()
    assert {r.doc_id for r in got} <= set(want)
    found = {r.doc_id for r in got if r.item_id == want[r.doc_id]}
    assert len(found) >= 0.97 * len(want)
    texts = dict(docs)
    for r in got:
        item = dict(items)[r.item_id].split()
        assert distance(item, texts[r.doc_id][r.start : r.end].lower().replace(",", "").split()) == r.distance <= decontam.allowed(len(item))
    kept = {r.doc_id for r in decontam.drop_matching(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {r.doc_id for r in got}
    assert decontam.matches(table, bench.limit(0)).count() == 0 and decontam.matches(table.limit(0), bench).count() == 0


def test_items_of_every_length_are_found_at_most_edits():
    source = random.Random(9)
    items = [[f"v{source.randrange(2000)}" for _ in range(n)] for n in [5] * 20 + [8] * 160 + [23] * 10 + [50] * 10 + [120] * 20 + [200] * 10]
    matcher, texts = decontam.Matcher([(i, " ".join(w)) for i, w in enumerate(items)]), []
    for item in items:
        words = item[:]
        for _ in range(decontam.allowed(len(item))):
            at, kind = source.randrange(len(words)), source.randrange(3)
            words[at : at + (kind != 0)] = [] if kind == 2 else ["zz"]
        texts.append(" ".join([f"u{source.randrange(300)}" for _ in range(source.randint(0, 90))] + words + ["u1"] * 40))
    missed = [len(items[i]) for i, hits in enumerate(matcher.find(texts)) if i not in {h[0] for h in hits}]
    assert missed == []


def test_short_items_and_scripts_without_blanks_are_found():
    items = ["v1 v2", "Zebra", "今日は天気がいいですね", "สวัสดีครับ"]
    matcher = decontam.Matcher(list(enumerate(items)))
    texts = ["u1 V1, v2 u2", "v1 u1 v2", "zebras", "a zebra. a zebra", "前に今日は天気がよいですね後", "ก่อนสวัสดีครับ", "天気", ""]
    hits = matcher.find(texts)
    assert [[(h[0], h[1]) for h in some] for some in hits] == [[(0, 0)], [], [], [(1, 0)], [(2, 1)], [(3, 0)], [], []]
    spans = [decontam.places(t, some)[0] for t, some in zip(texts, hits) if some]
    assert spans == [(3, 9), (2, 7), (2, 13), (4, 14)]


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_sketches_against_exact_shingles(spark, documents):
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())
    got = {r.doc_id: r for r in sketch.with_neighbours(documents).collect()}
    assert len(got) == len(rows)
    off = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r, a, b, c = got[key], shingles(text), shingles(edited), shingles(after)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off.append(abs(r.near_edited - len(a & b) / len(a | b)))
        assert abs(r.near_next - len(a & c) / len(a | c)) < 0.2 and abs(r.n_shingles - len(a)) <= 0.35 * len(a)
        assert abs(r.contained_in_edited - len(a & b) / len(a)) < 0.25
    assert max(off) < 0.2 and sum(off) / len(off) < 0.04


def test_merged_sketches_equal_the_whole(spark, odd, nothing):
    tool = sketch.Sketcher()
    parts = [(k % 2, sketch.to_text(tool.sketch(f"{k} " + " ".join(f"w{i}" for i in range(k * 40, k * 40 + 90))))) for k in range(6)] + [(7, "")]
    got = {r.g: r.fingerprint for r in sketch.merge(spark.createDataFrame(parts, "g int, fingerprint string"), "g").collect()}
    for g in (0, 1):
        whole = np.unique(np.concatenate([sketch.from_text(f) for k, f in parts if k == g]))[: sketch.SIZE]
        assert got[g] == sketch.to_text(whole)
    assert got[7] == ""
    again = {r.doc_id: r for r in sketch.with_neighbours(odd).collect()}
    assert again[2].fingerprint == again[3].fingerprint == "" and again[2].near_next == 1.0
    assert sketch.with_neighbours(odd).count() == odd.count()
    assert sketch.with_neighbours(nothing).count() == 0 and sketch.sketches(odd).count() == odd.count()


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])][::-1]
        if 14 <= len(d) <= 19 and sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns(odd, nothing):
    finder, source = pii.Finder(), random.Random(6)
    parts = ["@", "a", "b.c", ".", "1", "23", "4", "+", "+1", " ", "-", "(", ")", "x", "😀", "4381893557741609", "192.168", "_", "\n", "5"]
    for _ in range(4000):
        text = "".join(source.choice(parts) for _ in range(source.randint(1, 24)))
        assert [s for s in finder.spans(text) if s[1] < 4] == plain_spans(text), text
    assert finder.spans("0" * 5000 + ".1.2.3") == [(0, 1, 5006)] and finder.spans("7" * 5000 + "@") == []
    got = pii.find(odd)
    assert got.count() == odd.count() and pii.find(nothing).count() == 0
    row = got.where("doc_id = 1").first()
    assert (row.n_email, row.n_ip, row.spans) == (1, 1, "email:14:34,ip:54:64")


def test_added_spans_and_redaction(spark):
    finder = pii.Finder()
    text = 'IBAN DE89 3704 0044 0532 0130 00 token = "abc12345678" http://u:p1@h.com/x iban DE00 3704 0044 0532 0130 00 accounts 5'
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in finder.spans(text) if k > 3] == [("account", "DE89 3704 0044 0532 0130 00"), ("secret", "abc12345678"), ("login", "u:p1")]
    rows = spark.createDataFrame([(1, "mail a@b.co and 1.2.3.4", "z"), (2, None, None)], "doc_id long, text string, spans string")
    assert [tuple(r) for r in pii.redact(rows).orderBy("doc_id").collect()] == [(1, "mail [EMAIL] and [IP]", "z"), (2, None, None)]


@pytest.mark.parametrize("n", [5, 8, 10, 15, 20, 40, 80])
def test_tables_recall_texts_with_the_most_edits(n):
    draw = np.random.default_rng(n)
    items = [draw.integers(1, 5_000, n) for _ in range(60)]
    tables = decontam.Tables(list(range(60)), items)
    windows = np.stack([decontam.edited(x, tables.edits, draw) for x in items for _ in range(10)])
    met = [i in found for i, found in zip(np.repeat(np.arange(60), 10).tolist(), tables.agreeing(windows))]
    assert np.mean(met) >= 0.99 - 0.005  # 600 draws


def test_runs_that_many_items_and_places_share_are_expanded_in_slices(monkeypatch):
    source = random.Random(3)
    phrase = "a b c d e f"
    items = [(i, phrase + " " + " ".join(f"w{source.randrange(50)}" for _ in range(6))) for i in range(60)]
    texts = [" ".join([phrase + " w1 w2"] * 40), "", phrase, " ".join(t for _, t in items[:9]), items[5][1].replace("d", "z")]
    whole = decontam.Matcher(items).find(texts)
    monkeypatch.setattr(decontam, "EXPANDED", 50)
    assert decontam.Matcher(items).find(texts) == whole and len(whole[3]) >= 9
