from __future__ import annotations

import re
from collections import Counter

from arrears.llm import line_frequency as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = set()
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            covered.update(range(k, k + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_of_whole_table(small):
    texts = {r.doc_id: r.text for r in small.select("doc_id", "text").collect()}
    got = q.judge(small, ["doc_id"]).collect()
    assert {r.row.doc_id: figures(r) for r in got} == {i: base(t) for i, t in texts.items()}
    assert all(not (r.kept and r.base_failed) for r in got)


def body(k, n=30):
    return " ".join(f"w{k}x{j}" for j in range(n))


def brute(rows, most, least_left):
    """doc_id -> kept, for distinct ids in order of their rows."""
    norm = lambda x: " ".join(x.lower().split())
    lines = {i: [x for x in (t or "").split("\n") if x.split()] for i, t, _ in rows}
    host = {i: s or "" for i, _, s in rows}
    alike = {i: frozenset(norm(x) for x in lines[i]) for i in lines}  # documents of one set of lines are one
    bodies, first = {}, {}
    for i in lines:
        for x in lines[i]:
            bodies.setdefault((host[i], norm(x)), set()).add(alike[i])
            first.setdefault((host[i], norm(x)), set()).add(i)
    out = {}
    for i in lines:
        lost = sum(len(x.split()) for x in lines[i] if len(bodies[host[i], norm(x)]) > most)
        n = sum(len(x.split()) for x in lines[i])
        out[i] = (lost, n, 100 * (n - lost) >= least_left * n)
    return out, first, bodies


def test_boilerplate_goes_and_copies_stay(make):
    notice = " ".join(f"notice{j}" for j in range(400))
    rows = [(k, f"{notice}\n{body(k)}", "host") for k in range(12)]  # boilerplate in a host
    rows += [(100 + k, f"{notice}\n{body(100 + k)}", f"h{k}") for k in range(12)]  # the same line, other hosts
    copy = f"{body(500)}\n{body(501)}"
    rows += [(200 + k, copy, "host") for k in range(12)]  # copies of a clean document
    got = {r.row.doc_id: r for r in q.judge(make(*rows), ["doc_id"], most_documents=5).collect()}
    want, first, bodies = brute(rows, 5, q.LEAST_LEFT)
    exempt = [k for k in range(12) if got[k].n_boilerplate == 0]
    assert exempt == [0]  # the smallest document with a line keeps it
    for k in range(12):
        if k not in exempt:
            assert got[k].n_boilerplate == want[k][0] == 400 and got[k].kept is want[k][2] is False
    assert all(got[100 + k].kept and got[100 + k].n_boilerplate == 0 for k in range(12))
    assert all(got[200 + k].kept for k in range(12))
    cleaned = {r.doc_id: r for r in q.clean(make(*rows), most_documents=5, least_left=5).collect()}
    for k in range(12):
        if k not in exempt:
            assert cleaned[k].text == body(k) and cleaned[k].n_chars == len(body(k))


def test_shared_lines_count_all_their_documents(make):
    """A menu of five lines and one own line: whichever hash is the smallest, the menu is boilerplate."""
    menu = "\n".join(" ".join(f"menu{m}x{j}" for j in range(80)) for m in range(5))
    rows = [(k, f"{menu}\n{body(k)}", "host") for k in range(20)]
    copies = [(100 + k, f"{body(500)}\n{body(501)}", "host") for k in range(20)]
    got = {r.row.doc_id: r for r in q.judge(make(*rows, *copies), ["doc_id"], most_documents=15).collect()}
    assert [got[k].n_boilerplate for k in range(20)] == [0] + [400] * 19
    assert [got[k].kept for k in range(20)] == [True] + [False] * 19
    assert all(got[100 + k].kept and got[100 + k].n_boilerplate == 0 for k in range(20))


def test_pages_with_one_menu_lose_it(make):
    """200 different pages of a host with a menu of five lines, at the limits of the registered query."""
    menu = "\n".join(" ".join(f"menu{m}x{j}" for j in range(80)) for m in range(5))
    rows = [(k, f"{menu}\n{body(k)}", "host") for k in range(200)]
    got = {r.row.doc_id: r for r in q.judge(make(*rows), ["doc_id"]).collect()}
    assert [got[k].n_boilerplate for k in range(200)] == [0] + [400] * 199
    assert [got[k].kept for k in range(200)] == [True] + [False] * 199


def test_edge_cases(make):
    long = "\n".join(body(k) for k in range(3000))
    docs = make((1, None, "a"), (2, "", None), (3, long, None), (None, body(7), "a"), repeat=[(3, long, None)])
    got = q.judge(docs, docs.columns).collect()
    assert len(got) == 5
    assert {r.row.doc_id: r.kept for r in got} == {1: False, 2: False, 3: True, None: True}
    assert q.clean(docs).columns == docs.columns
    assert q.judge(make().limit(0), ["doc_id"]).collect() == []


def test_texts_are_neither_sorted_nor_handed_over_twice(make, monkeypatch):
    """What goes to Python holds the text once, and the join before it sorts no texts."""
    docs = make(*[(k, body(k), "a") for k in range(9)])
    given = []
    plain = q.without_lines
    monkeypatch.setattr(q, "without_lines", lambda df, *names: given.append(df) or plain(df, *names))
    assert q.clean(docs).columns == docs.columns
    (df,) = given
    assert "text" not in df.schema["held"].dataType.names and [f.name for f in df.schema] == ["held", "t", "h", "dropped"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan
