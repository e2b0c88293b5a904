"""Language model, quality classifier, URL filter."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np

from arrears.llm import lm_bloom as lm
from arrears.llm import mil_quality as mil
from arrears.llm import url_words as url


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def trained(docs, **options):
    docs = docs.withColumn("held_out", lm.held_out("doc_id", 10))
    model, counts = lm.train(docs.where("NOT held_out"), **options)
    return model, lm.score_texts(docs, model, counts, docs.columns)


def test_base_score_of_whole_table(small):
    model, scored = trained(small.select("doc_id", "text"), head=200)  # most tokens are joined, not broadcast
    rows = scored.collect()
    train = Counter()
    for r in rows:
        if zlib.crc32(str(r.row.doc_id).encode()) % 10:
            train.update(tokens(r.row.text))
    total, distinct = sum(train.values()), len(train)
    assert len(model["head"][0]) <= 200
    for r in rows:
        own = tokens(r.row.text)
        base = sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(t in train for t in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.row.held_out == (zlib.crc32(str(r.row.doc_id).encode()) % 10 == 0)
    held = [r for r in rows if r.row.held_out]
    per_token = lambda f: sum(f(r) for r in held) / sum(r.n_tokens for r in held)
    assert per_token(lambda r: r.score) > per_token(lambda r: r.base_score)  # better than single tokens, held out


def test_filter_gives_counts_back():
    """Levels are never too low, and seldom too high."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.6, len(hashes)), 10**6)
    bits, cut, field = 20, 12, np.zeros(1 << 17, np.uint8)
    size = 1 << bits - cut - 3
    for k in range(1 << cut):
        mine = lm.segments(hashes, cut) == k
        part = lm.field_of(hashes[mine], lm.levels(counts[mine]), bits - cut)
        field[k * size : (k + 1) * size] = np.frombuffer(part, np.uint8)
    want, got = lm.levels(counts), lm.probe(field, hashes, bits, cut)
    assert (got >= want).all() and (got > want).mean() < 0.1
    strange = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    assert (lm.probe(field, strange, bits, cut) > 0).mean() < 0.05
    exact = lm.middle(lm.levels(np.arange(1, 1000)))
    assert (np.abs(exact - np.arange(1, 1000)) <= 0.25 * np.arange(1, 1000) + 0.01).all()


def test_filter_grows_with_its_entries_and_probing_ends():
    for entries in (10**3, 10**6, 10**8, 2_900_000_000):
        bits = lm.bits_for(entries)
        rate = (1 - math.exp(-lm.PROBES * entries / 2**bits)) ** lm.PROBES
        assert rate <= lm.FALSE_LEVEL and (bits == lm.LEAST_BITS or rate > lm.FALSE_LEVEL / 8)
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**64, 200_000, dtype=np.uint64)
    bits, cut = lm.bits_for(len(hashes)), 12
    own = hashes[lm.segments(hashes, cut) == 7]
    part = np.frombuffer(lm.field_of(own, np.ones(len(own), int), bits - cut), np.uint8)
    assert (lm.probe(part, own, bits, cut, 1) == 1).all()  # a segment by itself
    full = np.full(1 << 17, 255, np.uint8)
    assert (lm.probe(full, hashes[:10], 20, cut, 5) == 5).all()
    assert (lm.probe(full, hashes[:10], 20, cut) == lm.MOST_LEVEL).all()


def test_stored_pairs_keep_their_segment():
    hashes = np.random.default_rng(5).integers(0, 2**64, 5_000, dtype=np.uint64)
    for cut in (6, 12, 20, 26):
        pairs = np.unique(lm.coarse(hashes, cut))
        full, places = lm.runs(pairs, cut)
        narrow = lm.narrowed(pairs, lm.TWO, cut)
        back = [lm.widened([narrow[i].tobytes()], lm.TWO, int(k), cut) for k, i in zip(full, places)]
        assert (np.concatenate(back) == pairs).all()


def test_segments_follow_the_input():
    """What meets in a task stays below a stated size while the input grows."""
    for size in (10**6, 10**9, 10**12, 10**14):
        assert size / 2 / 2 ** lm.segment_bits_for(size, 0) <= lm.GROUP
        assert lm.segment_bits_for(size, 0) <= 30


def test_largest_group_is_bounded_while_input_grows_tenfold(spark, small, monkeypatch):
    monkeypatch.setattr(lm, "GROUP", 2_000)
    docs = small.select("text")
    ten = docs.crossJoin(spark.range(10)).selectExpr("concat_ws(' ', text, id, 'w' || id) AS text")  # a fixture, no operator
    one, _ = lm.train(docs)
    more, _ = lm.train(ten)
    assert more["cut"] > one["cut"]
    assert one["largest"] <= 2 * lm.GROUP and more["largest"] <= 2 * lm.GROUP


def test_scores_against_exact_counts(small):
    """The model with exact counts of tokens and pairs: quantised ones stay near it, on held-out documents too."""
    _, scored = trained(small.select("doc_id", "text"))
    rows, train, pairs, texts = scored.collect(), Counter(), Counter(), 0
    for r in rows:
        if not r.row.held_out:
            own = tokens(r.row.text)
            train.update(own)
            pairs.update(zip([b" ", *own], own))
            texts += 1
    mass = sum(train.values()) + 0.1 * (len(train) + 1)
    errors = []
    for r in rows:
        exact = 0.0
        own = tokens(r.row.text)
        for left, right in zip([b" ", *own], own):
            seen = texts if left == b" " else train[left]
            trust = lm.MOST_TRUST * seen / (seen + lm.PRIOR)
            p = trust * min(pairs[left, right] / max(seen, 1), 1) + (1 - trust) * (train[right] + 0.1) / mass
            exact += math.log10(min(p, 1))
        errors.append(abs(exact - r.score) / len(own))
    assert sum(errors) / len(errors) < 0.03 and max(errors) < 0.3


def test_filter_as_table_gives_the_same_scores(small, make):
    odd = make((1, None, "a"), (2, "", "a"), (3, "x Y " * 400, None), (None, "x y", "a"), repeat=[(2, "", "a")])
    plain = lambda rows: sorted((str(r.row), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows)
    for docs, most in ((small, 0), (odd, 20)):  # none of the filter is sent, or that of tokens only
        docs = docs.select("doc_id", "text")
        sent, scored = trained(docs, one_bits=20, two_bits=21)
        kept, again = trained(docs, one_bits=20, two_bits=21, most_bits=most)
        assert set(sent["sent"]) == {lm.ONE, lm.TWO} and set(kept["sent"]) == ({lm.ONE} if most else set())
        assert plain(again.collect()) == plain(scored.collect())


def test_folded_hashes_come_back():
    rng = np.random.default_rng(6)
    for kind, number in ((lm.ONE, np.uint64), (lm.TWO, np.uint32)):
        for n in (0, 1, 5_000):
            own = np.unique(rng.integers(0, np.iinfo(number).max, n, dtype=number, endpoint=True))
            assert (lm.unfolded(lm.folded(own), kind) == own).all()
            assert (lm.from_planes(lm.planes(own), number) == own).all()


def test_segments_answer_exact_counts(spark, small):
    """Of tokens that are not frequent, too: no row for each of them and text is written or joined."""
    docs = small.select("doc_id", "text")
    _, joined = trained(docs, one_bits=20, two_bits=21, head=200)
    want = {r.row.doc_id: (r.n_known, r.base_score, r.score) for r in joined.collect()}
    for most in (0, 20):  # levels of tokens are asked for, or those of pairs only
        _, scored = trained(docs, one_bits=20, two_bits=21, head=200, most_bits=most)
        got = scored.collect()
        assert len(got) == len(want)
        for r in got:
            n_known, base, score = want[r.row.doc_id]
            assert r.n_known == n_known and math.isclose(r.base_score, base) and math.isclose(r.score, score)
        assert "Join" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_language_model_edge_cases(make):
    docs = make((1, None, "a"), (2, "", "a"), (3, "x Y " * 40_000, None), (None, "x y", "a"), repeat=[(2, "", "a")])
    options = {"one_bits": 20, "two_bits": 20}
    _, scored = trained(docs, **options)
    rows = scored.collect()
    assert len(rows) == 5
    by = {r.row.doc_id: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == 1 and by[1].base_score == by[2].base_score
    assert by[3].n_tokens == 80_001 and not by[None].row.held_out and by[None].n_known == 3
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    _, none = trained(docs.limit(0), **options)
    assert none.collect() == []
    model, counts = lm.train(docs.limit(0), **options)  # a model of nothing
    assert all(r.n_known == 0 and r.score == r.base_score == 0 for r in lm.score_texts(docs, model, counts, ["doc_id"]).collect())


def test_quality_on_held_out_documents(spark, folder):
    big = folder.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    model = mil.fit_quality(mil.labelled_sample(docs, labels, "doc_id", "quality", "text"))
    rows = mil.score_quality(docs, model, ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, quality[r.row.doc_id]) for r in rows
            if r.row.doc_id in quality and zlib.crc32(str(r.row.doc_id).encode()) % 5 == 0]
    right = np.mean([(s >= 0.3) == bool(y) for s, y in held])
    pairs = list(product([s for s, y in held if y], [s for s, y in held if not y]))
    assert right > 0.95 and np.mean([a > b for a, b in pairs]) > 0.97


def test_attention_gradients():
    rng = np.random.default_rng(2)
    x, bags, y = rng.normal(size=(9, mil.FEATURES)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    net = mil.Attention()
    loss = lambda: -np.mean([np.log(p if t else 1 - p) for p, t in zip(net.forward(x, bags)["p"], y)])
    for name, g in net.gradients(x, bags, y).items():
        at = tuple(rng.integers(0, n) for n in net.weights[name].shape)
        net.weights[name][at] += 1e-6
        up = loss()
        net.weights[name][at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[at]) < 1e-6
        net.weights[name][at] += 1e-6
    assert np.allclose(np.add.reduceat(net.forward(x, bags)["attention"], [0, 2, 6]), 1)


def test_passages_of_long_texts(monkeypatch):
    texts = [b"Ab c! " * 5000, b"", b"x", b"  \n y" * 10]
    x, bags = mil.encode(texts)
    assert bags.tolist() == [-(-10_000 // mil.PASSAGE), 1, 1, 1] and len(x) == bags.sum()
    assert np.allclose(x[0, :11].sum(), 1) and (x[bags[0]] == 0).all()
    monkeypatch.setattr(mil, "PART", 1000)
    assert mil.encode(texts)[1].sum() >= bags.sum()  # cut into parts, nothing lost


def test_quality_edge_cases(spark, make):
    docs = make((1, None, "a"), (2, "", None), (None, "a b", "a"), repeat=[(1, None, "a")])
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, 1)], "doc_id long, quality int")
    sample = mil.labelled_sample(docs, labels, "doc_id", "quality", "text")
    assert {r.label for r in sample.collect()} <= {1}
    one_class = mil.fit_quality(sample)
    scores = [r.score for r in mil.score_quality(docs, one_class, docs.columns).collect()]
    assert len(scores) == 4 and len(set(scores)) == 1
    blank = mil.fit_quality(mil.labelled_sample(docs, labels.limit(0), "doc_id", "quality", "text"))
    assert {r.score for r in mil.score_quality(docs, blank, ["doc_id"]).collect()} == {0.5}
    assert mil.score_quality(make().limit(0), blank, ["doc_id"]).collect() == []


def parts(address):
    if not address or "://" not in address:
        return "", ""
    rest = address.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :]).group()


def ruled(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in url.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, default=(0, None, None))[1:]


SPAM = ["freecasino", "casinobets", "cheappills", "bestpills", "freebets"]


def pages_of(spark):
    rows = [(k, f"http://{n}.example.org/{'win' if k % 2 else 'deal'}/{k}", f"<p>free {w} best cheap</p>")
            for k, (n, w) in enumerate(product(SPAM, ["garden", "music", "city", "letter"]))]
    rows += [(100 + k, f"http://{a}{b}.example.org/news/{k}", f"<a href='x'>{a} {b}</a> {a}")
             for k, (a, b) in enumerate(product(["garden", "music", "city", "letter", "river"], repeat=2))]
    odd = [None, "", "no scheme/x", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "x://a.example.com/en/", "x://com/", "x://com",
           "http://bad.net/es/é", "http://xnet/es/", "http://ÄB.net/fr/?x=://y/", "http://h#/en/", "x://u" + "v" * 3000 + ".org/a"]
    rows += [(200 + k, u, None) for k, u in enumerate(odd)] + [(200, None, None)]
    return spark.createDataFrame([(*r, "r", "o") for r in rows], "page_id long, url string, html string, row string, owner string")


def test_urls(spark):
    pages = pages_of(spark)
    rows = url.judge(pages, pages.columns).collect()
    assert len(rows) == pages.count()
    for r in rows:
        host, path = parts(r.row.url)
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0 else "allow"))
    by = {r.row.page_id: r for r in rows}
    assert by[0].words[:2] == ["free", "casino"] and by[4].words[:2] == ["casino", "bets"]
    assert by[101].words[:2] == ["garden", "music"]
    assert all(by[k].verdict == "block" for k in range(20))
    assert all(by[100 + k].verdict == "allow" for k in range(25))
    assert by[200].words == [] and by[200].verdict == "allow"


def best_split(name, counts, total):
    options = [[name[:k], *rest] for k in range(1, len(name)) for rest in best_split(name[k:], counts, total)] + [[name]]
    return options


def test_viterbi_against_all_splits():
    counts, total = {"a": 5.0, "ab": 9.0, "bc": 4.0, "abc": 1.0, "c": 2.0}, 50.0
    share = lambda w: math.log10(counts[w] / total) if w in counts else 1 - math.log10(total) - len(w)
    for name in ("abc", "abcabc", "xabz", "cabab", "q"):
        best = max(sum(map(share, s)) for s in best_split(name, counts, total))
        got = url.split_word(name, counts, total)
        assert "".join(got) == name and math.isclose(sum(map(share, got)), best)


def test_no_pages(spark):
    pages = pages_of(spark)
    assert url.judge(pages.limit(0), ["page_id"]).collect() == []
    assert {r.verdict for r in url.judge(pages.where("page_id >= 200"), ["page_id"]).collect()} == {"allow", "block"}


def test_base_places_of_a_dense_text_take_linear_time():
    import time

    from arrears.llm.license_rules import places

    words = b"cc by".split() * 1_000_000
    start = time.perf_counter()
    found = places(words)
    assert [w for w, _ in found] == list(range(0, 2_000_000, 2)) and {label for _, label in found} == {"cc-by"}
    assert time.perf_counter() - start < 30
