"""Quality rules and fingerprints against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from marketlens.llm import line_rules, version_sketch

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(rows):
    """rows: (doc_id, text, source)"""
    norm = lambda line: " ".join(SPACE.findall(line)).lower()
    lines = {}
    for d, t, s in rows:
        lines[d, t, s] = [x for x in (t or "").split("\n") if SPACE.search(x)]
    counts = defaultdict(set)
    for (d, t, s), ls in lines.items():
        for x in ls:
            counts[s, norm(x)].add(t or "")
    out = []
    for d, t, s in rows:
        t_ = t or ""
        w = SPACE.findall(t_)
        where = defaultdict(list)
        for i in range(len(w) - 7):
            where[tuple(w[i : i + 8])].append(i)
        hit = {j for places in where.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
        ls = lines[d, t, s]
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        hot = lambda x: len(counts[s, norm(x)]) > line_rules.LINE_DOCS
        removed = sum(len(x) for x in ls if hot(x))
        total = sum(map(len, ls))
        out.append((
            d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t_), len(ls) - len(set(ls)), len(hit), failed,
            not failed and not total - removed < line_rules.KEPT_SHARE * total, total, removed,
        ))
    return sorted(out)


@pytest.fixture(scope="module")
def rule_rows(corpus):
    rng = random.Random(1)
    rows = [(d, t, rng.choice(["a", "a", "a", "b", None])) for d, t in corpus]
    for i in range(60):
        menu = "Menu | home | about\nPlease log in to see prices and stock for all of our shops\n"
        menu += "Read more here and there, dear reader, every day of the week and again tomorrow\n"
        menu += " please  LOG in to see prices and stock for all of our shops\n" * rng.randrange(2)
        extra = " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(rng.choice([8, 90])))
        rows.append((5000 + i, menu + extra, "a"))
    for i in range(51):  # one line in 15 texts of no host, 15 of the empty one, 21 of c
        host = None if i < 15 else "" if i < 30 else "c"
        words = " ".join(f"{rng.choice('klmnop')}{rng.randrange(999)}" for _ in range(40))
        rows.append((6000 + i, f"{words}\nSubscribe to our letter of the week\n{words[::-1]}", host))
    rows += [(7000, "one two three\n" * 60, "a"), (7001, "\t\n \x0b", "a"), (7002, "x " * 20000, "b"), rows[0], rows[3], rows[3]]
    rows.append((rows[1][0], "another text under the same id " * 3, "a"))
    return rows


def test_rules_match_brute_force(spark, rule_rows):
    rows = [(d, t, s, "line", 3) for d, t, s in rule_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line string, host int").repartition(4)
    want = brute_rules(rule_rows)
    assert sorted(tuple(r) for r in line_rules.judged(docs).collect()) == want
    assert any(r[-1] and not r[7] and not r[6] for r in want), "no depleted document in the fixture"
    lost = {r[0]: r[9] for r in want if 6000 <= r[0] < 6051}
    assert {d for d, n in lost.items() if n} == set(range(6030, 6051)), "only c has the line in more than 20 texts"
    kept = line_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in want if r[7])
    given = {d: t for d, t, _ in rule_rows}
    letter = "\nSubscribe to our letter of the week"
    for r in got:
        if 6000 <= r.doc_id < 6051:
            assert r.text == (given[r.doc_id].replace(letter, "") if r.doc_id >= 6030 else given[r.doc_id])


def test_rules_without_broadcast(spark, rule_rows, monkeypatch):
    docs = spark.createDataFrame(rule_rows, "doc_id long, text string, source string").repartition(4)
    want = sorted(map(tuple, line_rules.judged(docs, with_text=True).drop("kept_text").collect()))
    monkeypatch.setattr(line_rules, "BROADCAST_BYTES", -1)
    got = line_rules.judged(docs, with_text=True).collect()
    assert sorted(tuple(r)[:-1] for r in got) == want == brute_rules(rule_rows)
    assert all((r.kept_text is None) != r.kept for r in got)


def test_rules_on_nothing(spark, empty):
    assert line_rules.judged(empty).collect() == []
    nulls = spark.createDataFrame([(1, None, None), (None, "x", "y")], "doc_id long, text string, source string")
    assert [tuple(r)[:8] for r in line_rules.judged(nulls).collect()] == [(1, 0, 0, 0, 0, 0, True, False)]


def paragraphs(text):
    return {p for p in re.split(r"\n|(?<=[a-e][.!?]) ", text) if p.strip(" ")}


def brute_versions(docs):
    ordered = sorted(docs, key=lambda x: -x[0])
    out = {}
    for i, (d, t) in enumerate(ordered):
        t, following = t or "", ordered[(i + 1) % len(ordered)][1] or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]

        def near(other):
            a, b = paragraphs(t), paragraphs(other)
            return len(a & b) / len(a | b) if a | b else 1.0

        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), near(edited), near(following), edited)
    return out


def test_fingerprints_match_brute_force(frame, corpus):
    want = brute_versions(corpus)
    rows = version_sketch.fingerprint_report(frame).collect()
    assert len(rows) == len(corpus)
    texts, prints = dict(corpus), {}
    for r in rows:
        n, sha, near_edited, near_next, edited = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)
        assert prints.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint


def test_large_differences_are_retried(spark, monkeypatch):
    rng = random.Random(4)
    sentence = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(1000)) for _ in range(5)) + "."
    docs = [(i, "\n".join(sentence() for _ in range(rng.randrange(1, 120)))) for i in range(60)]
    monkeypatch.setattr(version_sketch, "ROOM", 0.2)
    want = brute_versions(docs)
    for r in version_sketch.fingerprint_report(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert r.near_edited == pytest.approx(want[r.doc_id][2]) and r.near_next == pytest.approx(want[r.doc_id][3])


def test_retries_take_tasks_for_what_is_left(spark, monkeypatch):
    rng = random.Random(9)
    sentence = lambda: " ".join(rng.choice("abcdefghij") + str(rng.randrange(1000)) for _ in range(5)) + "."
    docs = [(i, "\n".join(sentence() for _ in range(3 if i % 40 else 150))) for i in range(200)]
    tasks = []
    monkeypatch.setattr(version_sketch, "ROOM", 0.3)
    monkeypatch.setattr(version_sketch, "differences", lambda p, s, n, f=version_sketch.differences: tasks.append(n) or f(p, s, n))
    want = brute_versions(docs)
    for r in version_sketch.fingerprint_report(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        assert r.near_edited == pytest.approx(want[r.doc_id][2]) and r.near_next == pytest.approx(want[r.doc_id][3])
    assert len(tasks) > 1 and all(n <= tasks[0] / 4 for n in tasks[1:])


def test_fingerprints_of_few_rows(spark, empty):
    assert version_sketch.fingerprint_report(empty).collect() == []
    (one,) = version_sketch.fingerprint_report(spark.createDataFrame([(5, "ab.\ncd")], "doc_id long, text string")).collect()
    assert one.near_next == 1.0 and one.n_chars == 6
    rows = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "y"), (None, "z")], "doc_id long, text string")
    got = version_sketch.fingerprint_report(rows).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 2, 2] and all(0 <= r.near_edited <= 1 for r in got)


def test_paragraphs_end_after_every_sentence(spark):
    """Sentences that end in capitals, digits, other letters or scripts are
    paragraphs too; a long stretch without an end is cut by its words."""
    rng = random.Random(6)
    ends = ["s.", "Z!", "7.", "é?", "ж.", ").", "a."]
    sentence = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(5)) + rng.choice(ends)
    docs = [(i, " ".join(sentence() for _ in range(30))) for i in range(20)]
    got = version_sketch.fingerprint_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    ordered = sorted(docs, reverse=True)
    split = lambda t: {p for p in re.split(r"(?<=[.!?]) ", t) if p.strip()}
    for i, (d, t) in enumerate(ordered):
        edited = t[: len(t) - len(t) // 3] + ordered[(i + 1) % len(ordered)][1][: len(t) // 3]
        a, b = split(t), split(edited)
        (r,) = (r for r in got if r.doc_id == d)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b)) and r.near_edited > 0.3
    words = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(4000))) for i in range(3)]
    for r in version_sketch.fingerprint_report(spark.createDataFrame(words, "doc_id long, text string")).collect():
        assert 0.3 < r.near_edited < 0.7 and r.near_next < 0.1


def test_long_lines_count(spark):
    """A passage of one line longer than 200 characters in many documents."""
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(i, f"{passage}\nx{i}", "a") for i in range(30)]
    rows = line_rules.judged(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert len(passage) > 200 and all(r.removed_chars == len(passage) and not r.kept and not r.base_failed for r in rows)


def test_frequent_lines_leave_the_text(spark):
    """Removed lines go from text and n_chars; all else stays in order."""
    rng = random.Random(9)
    docs, want = [], {}
    for i in range(30):
        own = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(3)]
        kept = [own[0], "", own[1], "  ", own[2], ""]
        docs.append((i, "\n".join(["Menu | home", *kept[:3], " menu |  HOME ", *kept[3:], "Menu | home"]), "a", 7))
        want[i] = "\n".join(kept)
    docs.append((99, "\n" + want[3] + " z\n", "a", 7))
    want[99] = docs[-1][1]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars int")
    got = line_rules.kept_documents(frame)
    assert got.dtypes == frame.dtypes
    assert {r.doc_id: (r.text, r.n_chars) for r in got.collect()} == {d: (t, 7 if d == 99 else len(t)) for d, t in want.items()}
    assert {r.doc_id: r.kept_text for r in line_rules.judged(frame, with_text=True).collect()} == want


def test_limit_holds_at_every_host_size(spark):
    """21 documents with a line lose it, however many others the host has."""
    body = "concat_ws(' ', transform(sequence(1, 25), x -> concat('w', id * 100 + x)))"
    docs = spark.range(5000).selectExpr("id as doc_id", f"if(id < 21, concat('Menu | home\\n', {body}), {body}) as text", "'a' as source")
    rows = line_rules.judged(docs).where("doc_id < 21").collect()
    assert len(rows) == 21 and all(r.removed_chars == 11 and r.kept for r in rows)
