"""Operators of quarry.llm against brute force, round trips and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import (
    adaptive_quality,
    chat,
    decontaminate,
    mixture,
    packing,
    pii_crf,
    probminhash,
    reshard,
    site_tree,
    toxicity,
)
from quarry.llm.shingles import Words, shingle_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string"
PLAIN = [f"w{n:03d}" for n in range(400)]


def prose(n: int, seed: int) -> str:
    return " ".join(random.Random(seed).choices(PLAIN, k=n))


def frame(spark, texts, sources=None):
    """Documents with columns whose names clash with those that operators use inside."""
    rows = [
        (n, t, "en" if n % 2 else None, sources[n] if sources else f"s{n % 3}", len(t or ""), "x", "y")
        for n, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", "   \n\t ", "a", "one two three", "x" * 50_000, prose(30_000, 1), "### $$$", "Ünï çödé 😀"]
EDGE = [*ODD, *ODD]


@pytest.fixture
def edge(spark):
    docs = frame(spark, EDGE)
    return docs.unionByName(docs.limit(3)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# Near-duplicates


def similar(a: str, b: str) -> bool:
    best = 0.0
    for pattern in (r"[^\x20\x09-\x0D]+", r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"):
        sets = []
        for t in (a, b):
            w = re.findall(pattern, t.lower())
            k = min(5, len(w))
            sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set())
        best = max(best, len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1])))
    return best >= 0.8


def test_classes_equal_brute_force(spark):
    rng, texts = random.Random(5), []
    for seed in range(25):
        words = prose(120, seed).split()
        texts.append(" ".join(words))
        for _ in range(seed % 4):
            copy = list(words)
            for _ in range(rng.choice([1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = "other" + str(rng.random())
            texts.append(" ".join(copy) + rng.choice(["", "!"]))
    texts += [texts[0], texts[0], None, "", "a b", "A b."]
    plain = [t or "" for t in texts]
    label = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if plain[a] == plain[b] or similar(plain[a], plain[b]):
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    want = {i: min(j for j in range(len(texts)) if label[j] == label[i]) for i in range(len(texts))}
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(frame(spark, texts)).collect()}
    assert got == want
    kept = probminhash.keep_one(frame(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_family_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "PIECE", 3)
    base = prose(200, 3).split()
    texts = [" ".join([*base[:n], f"new{n}", *base[n + 1 :]]) for n in range(0, 100, 5)]
    assert {r["class_id"] for r in probminhash.classes(frame(spark, texts)).collect()} == {0}


def brute_classes(texts):
    """The least number of each text's class, over all pairs."""
    sets = []
    for kind in (Words(), Words(marks=True)):
        sets.append([set(shingle_hashes(kind.hashes(t), 5).tolist()) for t in texts])
    label = list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for some in sets:
        for a, b in combinations(range(len(texts)), 2):
            both = len(some[a] & some[b])
            if both and 5 * both >= 4 * (len(some[a]) + len(some[b]) - both):
                x, y = top(a), top(b)
                label[max(x, y)] = min(x, y)
    return {i: top(i) for i in range(len(texts))}


def test_a_family_that_chains_and_spreads(spark):
    # Copies of one text whose similarity to it lies on both sides of the bound, chains away from it, and copies with parts left out.
    rng, base, texts = random.Random(9), prose(140, 77).split(), []
    for n in range(500):
        copy = list(base)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(len(copy))] = f"n{n}{rng.random()}"
        texts.append(" ".join(copy))
    for n in range(60):
        step = list(base)
        for k in range(6):
            step[(7 * n + 20 * k) % 140] = f"c{n}k{k}"
            texts.append(" ".join(step))
    texts += [" ".join(base[: rng.randrange(80, 140)]) for _ in range(60)]
    rng.shuffle(texts)
    texts = list(dict.fromkeys(texts))
    want = brute_classes(texts)
    every, label, later = probminhash.links(frame(spark, texts))
    ids = {r["node"]: r["doc_id"] for r in every.collect()}
    got: dict = {}
    for r in label.collect():
        got.setdefault(r["label"], []).append(ids[r["node"]])
    found = {i: min(some) for some in got.values() for i in some}
    assert {i: found.get(i, i) for i in want} == want
    assert 1 < len(set(want.values())) < len(texts) - 300
    # A straddling copy meets few others: nothing like all pairs is looked at again.
    assert later.count() < len(texts)


def test_candidates_cover_the_links(spark):
    rng, texts = random.Random(6), []
    for seed in range(50):
        line, tail = [prose(n, 100 * seed + n).split() for n in (10, 94)]
        edited = list(tail)
        edited[30], edited[60] = "one", "two"
        texts += [" ".join(line * 400 + tail), " ".join(line * 2 + edited)]
    for _ in range(5):
        marks = ["".join(rng.choices("#$%&*", k=6)) for _ in range(60)]
        texts += [" ".join(marks), " ".join([*marks[:-1], "###"])]
    assert all(similar(a, b) for a, b in zip(texts[::2], texts[1::2], strict=True))
    got = {r["doc_id"]: r["class_id"] for r in probminhash.classes(frame(spark, texts)).collect()}
    assert got == {n: n - n % 2 for n in range(len(texts))}


def test_sketch_estimates_similarity():
    a = np.arange(1, 601, dtype=np.uint64)
    agree = [
        (
            probminhash.prob_min_hash([(probminhash.mixed(a + np.uint64(k)), np.ones(600))])
            == probminhash.prob_min_hash([(probminhash.mixed(a[:450] + np.uint64(k)), np.ones(450))])
        ).mean()
        for k in range(40)
    ]
    assert abs(np.mean(agree) - 0.75) < 0.03


def test_sketch_does_not_depend_on_company():
    texts = [probminhash.weighted_shingles(prose(n, n), Words()) for n in (3, 40, 700)]
    together = probminhash.prob_min_hash(texts)
    for row, text in zip(together, texts, strict=True):
        assert (row == probminhash.prob_min_hash([text])[0]).all()


def test_classes_edge(edge, empty):
    assert probminhash.classes(edge).count() == edge.count()
    assert probminhash.keep_one(edge).count() == probminhash.classes(edge).select("class_id").distinct().count()
    assert probminhash.classes(empty).count() == 0 and probminhash.keep_one(empty).count() == 0


# Toxicity


def labelled(spark, n=400):
    texts, labels = [], []
    for k in range(n):
        bad = k % 5 == 0
        texts.append(prose(80, k) + (f" rotten{k % 7} vile{k % 3}" if bad else ""))
        labels.append((k, 1, int(bad)))
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out(spark):
    docs, labels = labelled(spark)
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["predicted"] == int(r["doc_id"] % 5 == 0)


def counted(text):
    """The terms of a text, written out: words, and beginnings of 3 to 6 bytes of longer ones."""
    found = Counter()
    for word in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower()):
        data = word.encode()
        found[data] += 1
        for n in (3, 4, 5, 6):
            if len(data) > n:
                found[n, data[:n]] += 1
    return found


def test_nearest_is_exact(spark):
    """The nearest examples by cosines that are computed from the texts alone."""
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2}
    found = {d: counted(texts[d]) for d in toxic}
    n1, n = sum(toxic.values()), len(toxic)
    weight = {}
    for term in {t for c in found.values() for t in c}:
        a, b = (sum(term in found[d] for d in toxic if toxic[d] == c) for c in (1, 0))
        chi2 = n * (a * (n - n1 - b) - b * (n1 - a)) ** 2 / (n1 * (n - n1) * (a + b) * max(n - a - b, 0.5))
        if a + b >= 2 and chi2 >= 3.84:
            weight[term] = (math.log((n + 1) / (a + b + 1)) + 1) * chi2 / (chi2 + 30)
    assert len(weight) == len(model.space)

    def vector(counts):
        v = {t: (1 + math.log(k)) * weight[t] for t, k in counts.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    vectors = {d: vector(c) for d, c in found.items()}
    for k in range(0, 400, 5):
        text = prose(80, k) + f" rotten{k % 7} vile{k % 3} rotten1"
        own = vector(counted(text))
        want = sorted(((-sum(x * v.get(t, 0.0) for t, x in own.items()), d) for d, v in vectors.items()))[:7]
        at, weights, _ = model.vector(toxicity.terms(text, Words()))
        best, near = model.nearest(at, weights, 7)
        assert np.allclose(near, [-c for c, _ in want[: len(near)]]) and sum(c < -1e-12 for c, _ in want) == len(near)
        ties = {round(c, 9) for c, _ in want}
        if len(ties) == len(want):
            assert model.ids[best].tolist() == [d for _, d in want[: len(near)]]


def test_toxicity_edge(spark, edge, empty):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    assert toxicity.score(edge, model).count() == edge.count()
    assert toxicity.reject(edge, model).count() == edge.count()
    assert toxicity.score(empty, model).count() == 0
    nothing = toxicity.fit(empty, labels.limit(0))
    assert {r["score"] for r in toxicity.score(edge, nothing).collect()} == {0.0}


# Decontamination


def test_leaks(spark, edge, empty):
    items = [prose(40, 9000 + n) for n in range(5)]
    benchmark = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id long, text string")
    edited = items[2].split()
    for n in range(0, 40, 6):
        edited[n] = "changed"
    texts = [
        prose(300, 1) + " " + items[0].upper() + ". " + prose(100, 2),
        prose(300, 3),
        " ".join(edited) + prose(50, 4),
        prose(200, 5) + " " + items[3] + " " + prose(900, 6) + " " + items[4],
        " ".join(items[1].split()[:10]) + " " + prose(200, 7),
    ]
    found = decontaminate.matches(frame(spark, texts), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (2, 2), (3, 3), (3, 4)}
    score = {(r["doc_id"], r["item_id"]): r["score"] for r in found}
    assert score[0, 0] == 1.0 and 0.4 < score[2, 2] < 1.0
    first = next(r for r in found if r["doc_id"] == 0)
    assert (first["start_word"], first["end_word"]) == (300, 340)
    left = decontaminate.remove_leaks(frame(spark, texts), benchmark)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 4]
    assert decontaminate.matches(edge, benchmark).count() == 0
    assert decontaminate.remove_leaks(edge, benchmark.limit(0)).count() == edge.count()
    assert decontaminate.remove_leaks(empty, benchmark).count() == 0


def test_frequent_leaks(spark):
    items = [prose(40, 9100 + n) for n in range(3)]
    # Items that have half of their words in common, as a template has.
    items += [" ".join([*items[0].split()[:20], *prose(20, 9200 + n).split()]) for n in range(30)]
    benchmark = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    edited = items[1].split()
    for n in range(0, 40, 6):
        edited[n] = "changed"
    half = " ".join(items[2].split()[:20])
    texts = [" ".join(edited)] * 50 + [f"{prose(60, n)} {half}" for n in range(50)]
    texts += [f"{prose(60, 100 + n)} {' '.join(items[0].split()[:20])}" for n in range(50)] + [prose(60, 200)]
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(frame(spark, texts), benchmark).collect()}
    wanted = {(n, 1) for n in range(50)} | {(n, 2) for n in range(50, 100)}
    assert found == wanted | {(n, i) for n in range(100, 150) for i in (0, *range(3, 33))}
    assert [r["doc_id"] for r in decontaminate.remove_leaks(frame(spark, texts), benchmark).collect()] == [150]


def test_alignment_equals_plain_smith_waterman():
    rng = random.Random(2)
    for _ in range(60):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 12))], np.uint64)
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 20))], np.uint64)
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1][j + 1] = max(0, h[i][j] + (2 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
        assert decontaminate.align(a, b)[0] == max(map(max, h))


# Mixture


def test_mixture_targets_and_words(spark, edge, empty):
    rng = random.Random(1)
    texts = [prose(rng.choice([5, 40, 200, 900]), n) for n in range(600)]
    sources = [rng.choice(["a", "a", "a", "b", "c", "é", None]) for _ in texts]
    docs = frame(spark, texts, sources)
    rows = mixture.mix(docs).collect()
    sizes: dict = {}
    for t, s in zip(texts, sources, strict=True):
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (1, 2, 3)[n % 3] for n, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
        free -= set(over)
    target |= share
    taken: dict = {}
    for r in rows:
        s = sources[r["doc_id"]]
        taken[s] = taken.get(s, 0) + r["taken"]
        assert r["size"] == len(texts[r["doc_id"]].split()) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in names)
    assert sorted(map(str, mixture.mix(docs).collect())) == sorted(map(str, rows))
    mixed = mixture.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert mixture.mix(edge).count() == edge.count() and mixture.mixed_rows(edge).count() > 0
    assert mixture.mix(empty).count() == 0 and mixture.mixed_rows(empty).count() == 0


# Pages


def test_pages(spark):
    body = "<article><header><h1>T</h1></header><p>a&amp;b  c<br>d<p>&#233;<b>x</b><div class=comments><p>no</p></div></article>"
    pages = [
        (1, "http://h/1", f"<html><head><title>no</title></head><body><nav>no</nav>{body}<aside>no</aside></body>"),
        (2, "http://h/2", "<script>var a='<p>no</p>'</script><style>p{}</style><form>no</form><main>yes<!-- no"),
        (3, None, None),
        (4, "", ""),
        (5, "nonsense", "<p>plain"),
        (5, "nonsense", "<p>plain"),
    ]
    # Named by nothing: what every page of a host says alike goes, what differs stays.
    pages += [(n, "http://many/", f"<div><span>same words</span></div><p>text {n} <i>of</i> its own") for n in range(10, 30)]
    found = site_tree.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(found) == len(pages)
    text = {r["page_id"]: r["text"] for r in found}
    assert text[1] == "T\na&b c d\néx" and text[2] == "yes" and text[3] == text[4] == "" and text[5] == "plain"
    assert all(text[n] == f"text {n} of its own" for n in range(10, 30))
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert site_tree.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_names_are_a_prior(spark):
    def page(n):
        own = "".join(f"<p>{prose(12, 1000 * n + k)}</p>" for k in range(1 + n % 4))
        menu = "<nav><ul><li>home</li><li>news</li></ul></nav><div class=sidebar>same aside</div>"
        hosts = {
            "wrapped": f"<body>{menu}<div class='sidebar'><main>{own}<div>same notice</div></main></div>",
            "parts": f"<body>{menu}<div class='content has-sidebar'>{own}</div>",
            "results": f"<body>{menu}<div id=search-results class=social-policy>{own}</div>",
            "unique": f"<body>{menu}<div class=social>{own}</div>",
            "talk": f"<body>{menu}<article>{own}<div class=comments><p>said {n} {prose(9, n)}</p></div></article>",
        }
        text = re.sub("</p>", "\n", own.replace("<p>", "")).strip()
        return [(n, f"http://{host}/{n}", html, text) for host, html in hosts.items()]

    pages = [row for n in range(20) for row in page(n)]
    frame = spark.createDataFrame([r[:3] for r in pages], "page_id long, url string, html string")
    found = {r["url"]: r["text"] for r in site_tree.extract(frame).collect()}
    assert found == {url: text for _, url, _, text in pages}


def test_hidden_is_an_attribute(spark):
    own = prose(30, 5)
    pages = ['<article title="a hidden gem">{}</article>', "<article class='post hidden sm'>{}</article>", "<article data-hidden=1>{}</article>"]
    gone = ["<div hidden>{}</div>", "<div class=x hidden=''>{}</div>", "<div HIDDEN>{}</div>", "<div aria-hidden=true>{}</div>"]
    rows = [(n, f"http://h{n}/", html.format(own)) for n, html in enumerate([*pages, *gone])]
    found = site_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in found} == {n: own if n < 3 else "" for n in range(7)}


# Personal data

REFERENCE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def test_base_spans_equal_patterns():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("01259.. @@+-()aé\n", k=rng.randrange(60)))
        want = []
        for n, (kind, pattern) in enumerate(REFERENCE.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub("[^0-9]", "", m[0])
                good = kind == "email"
                good |= kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                good |= kind == "card" and 13 <= len(digits) <= 19 and pii_crf.luhn(digits)
                good |= kind == "phone" and 9 <= len(digits) <= 15
                if good:
                    want.append((n, *m.span()))
        assert pii_crf.base_spans(text) == want, text


def test_field_labels_repeated_tokens(spark, edge, empty):
    texts = [f"{prose(20, n)} call +1 (017) 555-{7000 + n} {prose(20, n + 50)} and 555-{7000 + n} again, not 12" for n in range(60)]
    docs = frame(spark, texts)
    field = pii_crf.fit(docs)
    for r in pii_crf.spans(docs, field).collect():
        text = texts[r["doc_id"]]
        assert [s["kind"] for s in r["base"]] == ["phone"]
        assert [text[s["start"] : s["end"]] for s in r["added"]] == [f"555-{7000 + r['doc_id']}"]
    assert pii_crf.spans(edge, field).count() == edge.count()
    assert pii_crf.spans(empty, pii_crf.fit(empty)).count() == 0


# Packing


def test_field_reaches_all_repetitions(spark):
    once = [f"{prose(20, n)} call +1 (017) 555-{7000 + n} {prose(20, n + 50)} and 555-{7000 + n} again, not 12" for n in range(60)]
    many = f"{prose(20, 70)} call +1 (017) 555-7099 " + " ".join(f"{prose(20, 100 + n)} and 555-7099 again" for n in range(50))
    bare = " ".join(f"{prose(20, 200 + n)} call (017) 555-7098 {prose(9, n)}" for n in range(2))
    docs = frame(spark, [*once, many, bare])
    rows = {r["doc_id"]: r for r in pii_crf.spans(docs, pii_crf.fit(docs)).collect()}
    assert [many[s["start"] : s["end"]] for s in rows[60]["added"]] == ["555-7099"] * 50
    assert {s["kind"] for s in rows[60]["added"]} == {"phone"}
    assert not rows[61]["base"] and len(rows[61]["added"]) == 2
    assert all("555-7098" in bare[s["start"] : s["end"]] for s in rows[61]["added"])


def test_messages_settle():
    rng = random.Random(4)
    field = pii_crf.Field()
    field.pair[:] = np.random.default_rng(1).normal(0, 4, field.pair.shape)
    tokens = pii_crf.Tokens(" ".join(rng.choice(["1234567", "7654321", "55", "word"]) for _ in range(400)), [])
    before = field.beliefs(tokens)
    assert np.isfinite(before).all() and np.allclose(before.sum(axis=1), 1)


def test_room_tree_and_best_fit():
    rng = random.Random(4)
    lengths = [rng.randrange(1, 65) for _ in range(500)]
    rows = packing.best_fit_decreasing(lengths, 64)
    assert sorted(n for row in rows for n in row) == list(range(500))
    room: list[int] = []
    for n in sorted(range(500), key=lambda n: -lengths[n]):
        fits = [r for r in room if r >= lengths[n]]
        best = min(fits) if fits else 64
        if fits:
            room.remove(best)
        room.append(best - lengths[n])
    assert sorted(64 - sum(lengths[n] for n in row) for row in rows) == sorted(room)


def test_an_encoder_for_each_vocabulary():
    ranks = packing.read_vocabulary(packing.VOCABULARY)
    last, before = sorted(ranks, key=ranks.get)[-1:-3:-1]
    other = {**ranks, last: ranks[before], before: ranks[last]}
    assert packing.encoder(ranks) is packing.encoder(dict(ranks)) and packing.encoder(ranks) is not packing.encoder(other)
    assert packing.encoder(other).encode_single_token(last) == ranks[before]


def test_rows_that_differ_in_a_map_or_variant_are_all_kept(spark):
    base = frame(spark, ["the same text"] * 6).withColumns({"doc_id": F.lit(1).cast("long"), "lang": F.lit("en"), "source": F.lit("s")})
    numbered = base.withColumn("n", F.monotonically_increasing_id().cast("string"))
    mapped = numbered.select(*base.columns, F.create_map(F.lit("k"), "n").alias("extra"))
    varied = numbered.select(*base.columns, F.to_variant_object(F.struct("n")).alias("extra"))
    for docs in (mapped, varied):
        want = sorted(r[0] for r in docs.select(F.to_json(F.struct("extra"))).collect())
        assert len(set(want)) == 6
        got = reshard.reshard(docs).select(F.to_json(F.struct("extra"))).collect()
        assert sorted(r[0] for r in got) == want


def test_packing_round_trip(edge, empty):
    rows = packing.packed(edge, length=128)
    encode = packing.encoder(packing.read_vocabulary(packing.VOCABULARY)).encode_ordinary
    for r in rows.collect():
        ids, positions = packing.matrix([r["ids"]])[0], packing.matrix([r["positions"]])[0]
        assert len(ids) == 128 and r["cu_seqlens"][-1] == r["n_tokens"] and (ids[r["n_tokens"] :] == packing.PADDING).all()
        assert np.flatnonzero(positions[: r["n_tokens"]] == 0).tolist() == r["resets"] == r["cu_seqlens"][:-1]
    whole: dict = {}
    for r in packing.unpack(rows).distinct().orderBy("doc_id", "start").collect():
        whole.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u2").tolist())
    for r in edge.where("doc_id is not null").collect():
        assert whole.get(r["doc_id"], []) == encode(r["text"] or "")
    assert packing.packed(empty).count() == 0


# Chat


def test_chat_layouts_and_round_trip(spark):
    odd = "\\### a </turn>\n \\b\\h<#😀"
    lines = [
        '{"conv_id":1,"turn":0,"role":"user","text":"q"}',
        '{"conv_id":1,"turn":1,"role":"assistant","text":null}',
        '{"conv_id":2,"prompt":"p","response":"r"}',
        '{"conv_id":3,"instruction":"i","input":"n","output":"o"}',
        '{"conv_id":4,"messages":[{"role":"user","content":"x"},{"role":"assistant","content":"y"}]}',
        '{"conv_id":5,"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}',
        '{"conv_id":6,"unknown":[1,2]}',
    ]
    records = spark.createDataFrame([(x,) for x in lines], "j string").select(F.parse_json("j").alias("record"))
    assert chat.unmapped(records).collect()[0]["n"] == 1
    turns = chat.canonical_turns(records)
    more = [(None, 1, None, odd), (7, None, "assistant", odd), (7, 0, "sys\ntem", None), (7, 0, "sys\ntem", None)]
    turns = turns.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    formatted = chat.format_turns(turns)
    read = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    said = {k: [(t["role"], t["text"]) for t in r["turns"]] for k, r in read.items()}
    assert said == {
        1: [("user", "q"), ("assistant", "")],
        2: [("user", "p"), ("assistant", "r")],
        3: [("system", "i"), ("user", "n"), ("assistant", "o")],
        4: [("user", "x"), ("assistant", "y")],
        5: [("user", "x"), ("assistant", "y")],
        7: [("sys\ntem", ""), ("sys\ntem", ""), ("assistant", odd)],
        None: [("", odd)],
    }
    assert read[7]["learned"] == [odd] and read[1]["learned"] == [""] and read[None]["learned"] == []
    assert chat.format_turns(turns.limit(0)).count() == 0


# Resharding


def test_flow_moves_least():
    rng = random.Random(6)
    for _ in range(40):
        supply = [rng.randrange(100) for _ in range(4)]
        total = sum(supply)
        capacity = [total // 6 + (j < total % 6) for j in range(6)]
        flow = reshard.min_cost_flow(supply, capacity, [[int(i != j) for j in range(6)] for i in range(4)])
        assert [sum(row) for row in flow] == supply and [sum(col) for col in zip(*flow, strict=True)] == capacity
        # With equal prices per move, no plan can keep more than the smaller of both sides.
        assert sum(flow[i][i] for i in range(4)) == sum(min(supply[i], capacity[i]) for i in range(4))


def test_flow_with_prices():
    assert reshard.min_cost_flow([5, 5], [5, 5], [[1, 2], [1, 9]]) == [[0, 5], [5, 0]]


def test_shards(spark, edge, empty, tmp_path):
    texts = [prose(random.Random(n).randrange(1, 60), n % 900) for n in range(2000)]
    rows = reshard.assign(frame(spark, texts), piece_rows=10).collect()
    assert len(rows) == 2000
    by_shard: dict = {}
    where: dict = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
    assert sorted(by_shard) == list(range(16)) and all(len(x) == 1 for x in where.values())
    sizes = [sum(r["size"] for r in x) for x in by_shard.values()]
    assert max(sizes) <= 1.05 * min(sizes)
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in by_shard.values())
    resharded = reshard.reshard(edge.withColumn("slot", F.lit("old")))
    assert resharded.count() == edge.count() == resharded.select("shard", "slot").distinct().count()
    assert reshard.assign(empty).count() == 0 and reshard.reshard(empty).count() == 0
    reshard.rewrite(resharded, str(tmp_path / "shards"))
    moved = {s for r in resharded.where("old_shard <> shard").collect() for s in (r["old_shard"], r["shard"])}
    written = {r["shard"] for r in spark.read.parquet(str(tmp_path / "shards")).select("shard").distinct().collect()}
    assert written <= moved


def test_group_larger_than_a_shard_is_split(spark):
    rows = reshard.assign(frame(spark, ["same text of a large group"] * 900 + [prose(9, n) for n in range(900)])).collect()
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    assert max(sizes) <= 1.35 * min(sizes)


def test_groups_beside_a_giant_stay_whole(spark):
    # One block for each old shard: every block has to be split, that of the large group as well.
    texts = ["same text of a large group"] * 900 + [prose(9, n % 300) for n in range(1200)]
    rows = reshard.assign(frame(spark, texts), fine=1).collect()
    where: dict = {}
    for r in rows:
        where.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    giant = where.pop(texts[0])
    assert len(rows) == len(texts) and len(giant) > 1 and all(len(x) == 1 for x in where.values())
    alike = frame(spark, [*texts[:1], *texts[900:]]).withColumn("copies", F.when(F.col("doc_id") == 0, 900).otherwise(1))
    alike = alike.select("*", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "col")
    rows = reshard.assign(alike.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    sizes = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(16)]
    assert max(sizes) <= 1.35 * min(sizes)


# Quality


def test_quality_measures_and_verdicts(spark, edge, empty):
    rng = random.Random(8)
    texts = [prose(120, n) for n in range(300)] + ["## $$ " * 60, "\n".join(["one two three four"] * 30), "short"]
    texts += ["".join(rng.choices("ab \n#", k=rng.randrange(80))) for _ in range(60)]
    rows = {r["doc_id"]: r for r in adaptive_quality.assess(frame(spark, texts, ["s"] * len(texts))).collect()}
    for n, text in enumerate(texts):
        words, r = re.findall(r"[^\x20\x09-\x0D]+", text), rows[n]
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert all(rows[n]["kept"] for n in range(300)) and not rows[300]["kept"] and not rows[301]["kept"]
    assert adaptive_quality.assess(edge).count() == edge.count()
    assert adaptive_quality.assess(empty).count() == 0 and adaptive_quality.keep(empty).count() == 0


def test_sketches_merge(spark):
    docs = frame(spark, [prose(60 + n, n) for n in range(200)])
    measured = adaptive_quality.measures(docs)
    parts = adaptive_quality.sketches(measured.where("doc_id < 90")).unionByName(
        adaptive_quality.sketches(measured.where("doc_id >= 90"))
    )
    key = lambda df: sorted(map(str, adaptive_quality.thresholds(df, 10).collect()))
    assert key(parts) == key(adaptive_quality.sketches(measured))


# Pipeline


def test_pipeline(spark):
    import corpus_pipeline

    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r["shard"] for r in out} <= set(range(16)) and len({(r["shard"], r["slot"]) for r in out}) == len(out)
    assert len({hashlib.md5((r["text"] or "").encode()).digest() for r in out}) <= len(out)
