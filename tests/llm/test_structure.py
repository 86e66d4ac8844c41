"""Filter interaction, conversation repair and fast sketches against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from subvent.llm import conversation_repair, fast_sketch, filter_audit

WHITE = " \t\n\x0b\x0c\r"

# filters


def fails_of(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    return "".join(
        c
        for c, bad in (
            ("A", len(words) < 100),
            ("B", 100 * len(set(words)) < 80 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 10 * len(text)),
            ("D", re.search("[#$%&*|]", text) is not None),
        )
        if bad
    )


def brute_audit(docs, labels):
    least = {}
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", float("inf")), float("inf") if i is None else i)
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    rows = [(p or "", fails_of(t or "") + ("E" if (float("inf") if i is None else i) > least[t or ""] else ""), i) for i, t, p in docs]
    out, removed = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, _, _ in rows}:
            left = [(f, i) for p, f, i in rows if p == part]
            for step, c in enumerate(order, 1):
                here = [(f, i) for f, i in left if c in f]
                all_failing = [f for p, f, _ in rows if p == part and c in f]
                left = [x for x in left if c not in x[0]]
                out[part, order, step] = (len(left), len(here), len(all_failing) - len(here), all_failing.count(c), sum(i in good for _, i in here), sum(i in toxic for _, i in here))
                removed[part, c] += len(here)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def filter_rows():
    rng = random.Random(3)
    words = ["the", "Of", "AND", "that", "é", "ß$", "x"] + [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(rng.choice(words[: rng.choice((3, 127))]) for _ in range(rng.choice((0, 5, 99, 100, 130)))), rng.choice(["en", "de", None])) for i in range(60)]
    docs += [(100 + i, docs[7][1], "en") for i in range(30)]  # a text that a third of all rows share
    docs += [(200, None, "en"), (201, "", None), (202, "\t \x0b", ""), (None, docs[9][1], "de"), (None, "only here", "de"), (None, "only here", "de")]
    docs += [(5, docs[5][1], "en"), (5, docs[5][1], "de"), (203, "\x1c\x85\xa0word   two", "en")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 120, 2)] + [(2, 1, False), (2, None, True), (None, 1, True)]
    return docs, [(i, q, int(x)) for i, q, x in labels]


def audit_of(spark, docs, labels, parts=3):
    # names that the operator uses itself
    table = spark.createDataFrame([(i, t, p, 1, "t", 2) for i, t, p in docs], "doc_id bigint, text string, lang string, words int, part string, fails int").repartition(parts)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    counts = filter_audit.failure_counts(filter_audit.document_facts(table), marks, filter_audit.contract_filters())
    return filter_audit.every_order(*counts)


def test_every_order_of_the_filters(spark):
    docs, labels = filter_rows()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in names) for r in audit_of(spark, docs, labels).collect()}
    assert found == brute_audit(docs, labels)


def test_no_documents_no_parts(spark):
    assert audit_of(spark, [], []).collect() == []


def test_transducer_counts():
    texts = ["", " ", "a", "a a\tb", "É É é", "AbC#|", "x" * 70_000 + " " + "x" * 70_000, " the the\r\nthe ", "\U0001f600 \U0001f600z"]
    found = filter_audit.transduce(pa.array(["skipped", *texts], pa.large_string()).slice(1))
    for k, t in enumerate(texts):
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        want = (len(words), len(set(words)), len(re.findall("[A-Z]", t)), len(t), len(re.findall("[#$%&*|]", t)), len(t.encode()))
        assert tuple(int(v[k]) for v in found.values()) == want


def test_equal_hashes_are_told_apart_by_their_bytes():
    rng = random.Random(0)
    words = [rng.choice("ab") + rng.choice("cd") * rng.randrange(1, 3) for _ in range(200)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    owner = np.arange(200) // 50
    new = filter_audit.distinct_spans(data, owner, starts, ends, np.zeros(200, np.uint64))
    assert new.sum() == len({(o, w) for o, w in zip(owner.tolist(), words, strict=True)})


# conversations

STEP = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_repair(rows):
    """Rows (turn, role, text) in order: the report by trying every edit."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(WHITE)
        faults.append("b" if not core else "d" if (role, text) in seen else "" if core[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]

    @lru_cache(None)
    def best(i, q, inserted):
        options = [(0, "", "")] if i == len(rows) and q in "0a" else []

        def add(cost, edit, row, rest):
            options.append((cost + rest[0], edit + rest[1], ("" if row is None else f"\n{row[0]}:{row[1]}") + rest[2]))

        if i < len(rows):
            add(2, "D", None, best(i + 1, q, 0))
            if faults[i] in ("", "t"):
                more, text = 5 * (faults[i] == "t"), rows[i][2]
                if (q, initials[i]) in STEP:
                    add(more, "K", (rows[i][1], text), best(i + 1, STEP[q, initials[i]], 0))
                for name in ("user", "assistant"):
                    if (q, name[0]) in STEP:
                        add(1 + more, "R", (name, text), best(i + 1, STEP[q, name[0]], 0))
        for name in ("user", "assistant"):
            if inserted < 3 and (q, name[0]) in STEP:
                add(5, "I", (name, ""), best(i, STEP[q, name[0]], inserted + 1))
        return min(options, key=lambda o: o[:2], default=(10**9, "~", ""))

    cost, audit, text = best(0, "0", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), wrong, cost, audit, hashlib.sha256(text[1:].encode()).hexdigest()


def in_order(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for conv in [*range(150), None]:
        for k in range(rng.randrange(0, 9) + 1):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ai"])
            text = rng.choice(["Yes.", "No", "", None, " \n", f"t{k}!", f"t{k}? \x0b", "x\x1c", "Yes."])
            rows.append((conv, rng.choice([k, k, k, 2 * k, None]), role, text))
    rows += [(500, k, ("user", "assistant")[k % 2] if k % 17 else "system", f"turn {k}" + "." * (k % 5 > 0)) for k in range(3000)]
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string, gone boolean, place int, audit string"


def table_of(spark, rows, gone=lambda r: False):
    return spark.createDataFrame([(*r, gone(r), 1, "a") for r in rows], SCHEMA).repartition(4)


def test_least_repairs(spark, monkeypatch):
    rows = conversation_rows()
    found = conversation_repair.repair(table_of(spark, rows)).persist()
    reports = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.reports(found).collect()}
    by_conv = {}
    for conv, *row in rows:
        by_conv.setdefault(conv, []).append(row)
    assert set(reports) == set(by_conv)
    for conv, own in by_conv.items():
        if len(own) < 100:
            assert reports[conv] == brute_repair(in_order(own)), conv
    # the repaired rows themselves
    texts = {}
    for r in sorted(conversation_repair.repaired_rows(found).collect(), key=lambda r: r["place"]):
        texts.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"], r["edit"]))
    for conv, report in reports.items():
        own = texts.get(conv, [])
        assert [p for p, *_ in own] == list(range(1, len(own) + 1))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t, _ in own).encode()).hexdigest() == report[-1]
        assert "".join(e for *_, e in own) == report[-2].replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _, _ in own))
    found.unpersist()


def test_tasks_of_few_rows_plan_alike(monkeypatch):
    rng = random.Random(1)
    part = pa.table({
        "conv_id": pa.array(sorted(rng.randrange(40) for _ in range(600)), pa.int64()),
        "turn": pa.array(range(600), pa.int64()),
        "role": [rng.choice(["user", "assistant", "system"]) for _ in range(600)],
        "digest": pa.array([bytes([rng.randrange(250)] * 16) for _ in range(600)], pa.binary()),
        "gone": [rng.random() < 0.1 for _ in range(600)],
        "blank": [rng.random() < 0.1 for _ in range(600)],
        "stopped": [rng.random() < 0.9 for _ in range(600)],
    })
    whole = conversation_repair.plan_conversations(part).to_pylist()
    monkeypatch.setattr(conversation_repair, "ROWS_AT_ONCE", 20)
    batches = [b for k in range(0, 600, 7) for b in part.slice(k, 7).combine_chunks().to_batches()]
    assert [r for b in conversation_repair._plan(iter(batches)) for r in b.to_pylist()] == whole


def test_damage_and_no_rows_left(spark):
    rows = [(c, t, "user", "Hello. You?") for c in range(40) for t in (0, 1, None)]
    found = conversation_repair.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    kinds = Counter()
    for r in found.collect():
        fault = zlib.crc32(f"{r['conv_id']}:{' ' if r['turn'] is None else r['turn']}".encode()) % 20
        kinds[fault] += 1
        assert r["gone"] == (fault == 0)
        assert r["text"] == {1: "", 2: "Hello You"}.get(fault, "Hello. You?")
    assert kinds[3] % 2 == 0 and kinds[3] > 0 and kinds[0] > 0
    gone = conversation_repair.repair(table_of(spark, [(1, 0, "user", "a."), (2, 0, "user", "b.")], lambda r: r[0] == 1))
    reports = {r["conv_id"]: tuple(r)[1:] for r in conversation_repair.reports(gone).collect()}
    assert reports[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reports[2][5:7] == (2, "D")
    assert conversation_repair.repair(table_of(spark, [])).collect() == []


def test_ranks_choose_between_arcs_of_one_letter():
    rng = np.random.default_rng(2)
    n = 60
    letters, targets = np.zeros((n, 4), np.uint8), np.zeros((n, 4), np.int32)
    for v in range(n - 4):
        for k in range(rng.integers(1, 5)):
            letters[v, k], targets[v, k] = rng.choice([65, 65, 66]), rng.integers(v + 1, n)
    best = {}
    for v in reversed(range(n)):
        best[v] = min((bytes([letters[v, k]]) + best[int(targets[v, k])] for k in range(4) if letters[v, k]), default=b"")
    first, jumps, lengths = conversation_repair.least_paths(letters, targets)
    for v in range(n):
        at, path = v, b""
        while first[at]:
            path += bytes([first[at]])
            at = int(jumps[0][at])
        assert path == best[v] and lengths[v] == len(path)


# fast sketches


def test_every_coordinate_fills_and_agrees_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (0, 1, 2, 7, 200, 5000)]
    found = fast_sketch.fast_sketches(np.concatenate(sets), np.asarray([len(s) for s in sets]), 192)
    assert (found[0] == 0).all() and (found[1:] < 1 << 32).all()
    alone = fast_sketch.fast_sketches(sets[4], np.asarray([200]), 192)
    assert (alone[0] == found[4]).all()
    shares = []
    for _ in range(60):
        both = rng.integers(0, 2**63, 100, dtype=np.uint64)
        more = rng.integers(0, 2**63, 40, dtype=np.uint64)
        a, b = np.concatenate([both, more[:20]]), np.concatenate([more[20:], both])
        x = fast_sketch.fast_sketches(np.concatenate([a, b]), np.asarray([120, 120]), 192)
        shares.append((x[0] == x[1]).mean())
    assert abs(np.mean(shares) - 100 / 140) < 0.01
    assert np.std(shares) < 0.06


def brute_components(rows):
    sets = []
    for _, t in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in t or "")
        words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for k, (i, _) in zip(label, rows, strict=True):
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return sorted(((i, len(s), least[k], i == least[k]) for (i, _), s, k in zip(rows, sets, label, strict=True)), key=repr)


def families(copies=60):
    """Texts, families of copies changed a little or a lot, chains, exact copies in another case, and odd rows."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for _ in range(30):
        rows.append(" ".join(word() for _ in range(rng.choice((3, 20, 150)))))
    for size in (copies, 20):
        base = [word() for _ in range(150)]
        rows += [" ".join(w if rng.random() > rate else word() for w in base) for rate in (0.0, 0.005, 0.01, 0.02) for _ in range(size // 4)]
    chain = [word() for _ in range(120)]
    for k in range(12):  # neighbours are alike, ends are not
        chain = chain[:10 * k] + [word()] + chain[10 * k + 1 :] if k < 12 else chain
        rows.append(" ".join(chain))
    rows += [rows[3].upper(), "  " + rows[4].replace(" ", "\n"), rows[5] + " one", "É a b c d e", "é a b c d e", "two words", "TWO\twords", "", "\r\n", None, "a " * 50, "a " * 9]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [*zip(ids, rows, strict=True), (None, rows[0]), (None, "nobody else has this"), (7, rows[1]), (7, rows[1])]


@pytest.mark.parametrize("copies", [40, 160])
def test_components_of_near_copies(spark, copies):
    rows = families(copies)
    table = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id bigint, text string, n int, rep int, label string").repartition(3)
    found = [tuple(r) for r in fast_sketch.near_duplicates(table).collect()]
    assert sorted(found, key=repr) == brute_components(rows)


def test_a_text_longer_than_a_slice(spark):
    rng = random.Random(2)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(400_000))
    rows = [(3, long), (1, long + " more"), (2, "short"), (4, long.replace(" ", "  "))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: (r["component_id"], r["kept"]) for r in fast_sketch.near_duplicates(table).collect()}
    assert found == {1: (1, True), 2: (2, True), 3: (1, False), 4: (1, False)}
    facts = {r["doc_id"]: (r["words"], r["distinct_words"], r["code_points"]) for r in filter_audit.document_facts(table.withColumn("lang", table["text"].substr(1, 1))).collect()}
    assert facts[1] == (400_001, len(set(long.split())) + 1, len(long) + 5)


def test_no_documents(spark):
    assert fast_sketch.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, " ")], "doc_id bigint, text string")
    assert {tuple(r) for r in fast_sketch.near_duplicates(nothing).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}
