"""Language, quality, near duplicates and repeated passages against brute force."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from subvent.llm import chosen_path, langid, quality, substring

SCHEMA = "doc_id bigint, text string, doc string, _row int, n bigint, kept string"  # names the operators use themselves


def table_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "d", 1, 2, "k") for i, t in rows], SCHEMA).coalesce(1).repartition(parts, "doc_id") if rows else spark.createDataFrame([], SCHEMA)


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


# language


LANGUAGES = {
    "aa": ["the", "of", "and", "that", "with", "this", "have", "thing"],
    "bb": ["der", "die", "und", "nicht", "auf", "ein", "schön", "über"],
    "cc": ["les", "des", "une", "être", "dans", "pour", "qui", "été"],
}


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(0)
    rows = [(i, sentence(rng, LANGUAGES[k], 1 + i % 30), k) for i, k in enumerate(sorted(LANGUAGES) * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 ... !!!", "cc"), (903, "the thing", None), (None, "nicht über", "bb"), (0, rows[0][1], "aa")]
    return spark.createDataFrame([(i, t, k, 0.5, "l") for i, t, k in rows], "doc_id bigint, text string, lang string, score double, lang_pred string").repartition(3)


def test_held_out_texts_are_told_apart(languages):
    train = languages.filter(~langid.held_out(languages["doc_id"]))
    found = langid.predict(languages, langid.fit(train)).collect()
    assert len(found) == languages.count()
    for r in found:
        text = r["doc"]["text"]
        if text and re.search(r"[^\W\d_]", text):
            words = set(text.split())
            assert words <= set(LANGUAGES[r["lang_pred"]])
            assert 0 < r["score"] <= 1
        else:
            assert (r["lang_pred"], r["score"], r["ambiguous"]) == ("und", 0.0, True)


def test_held_out_is_the_remainder(languages):
    for r in languages.select("doc_id", langid.held_out(languages["doc_id"]).alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 4 == 2)


def test_neither_rows_nor_partitions_change_the_model(languages):
    a, b = langid.fit(languages), langid.fit(languages.repartition(7))
    assert a.languages == b.languages == ("aa", "bb", "cc")
    assert (a.weights == b.weights).all()


def test_learning_from_nothing_or_one_language(languages):
    assert {r["lang_pred"] for r in langid.predict(languages, langid.fit(languages.filter("false"))).collect()} == {"und"}
    one = langid.fit(languages.filter("lang = 'aa'"))
    assert {r["lang_pred"] for r in langid.predict(languages, one).collect()} == {"aa", "und"}
    assert langid.predict(languages.filter("false"), one).collect() == []


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 40, 200])
def test_code_words(n):
    words = langid.code_words(n)
    assert set(np.unique(words)) == {-1.0, 1.0}
    assert (np.abs(words.sum(axis=0)) < n).all()
    apart = (words.shape[1] - words @ words.T) / 2 + np.eye(n) * words.shape[1]
    assert apart.min() >= (words.shape[1] + 1) // 2 if n <= langid.MOST_EXHAUSTIVE else apart.min() >= 8


def test_one_wrong_bit_is_corrected():
    words = langid.code_words(4)
    model = langid.Model(("a", "b", "c", "d"), words, np.zeros((1, 7)), np.ones(7) / 7)
    for k in range(4):
        for bit in range(7):
            odds = 3 * words[k].copy()
            odds[bit] = -odds[bit]
            assert langid._decode(model, odds[None])[0][0] == k
    near, score, against = langid._decode(model, np.zeros((1, 7)))
    assert score[0] == pytest.approx(0.25) and against[0] == pytest.approx(0.5)


def test_grams_stay_inside_texts():
    texts = pa.array(["", "a", "ab", "Abc 1 é", "b", ""], pa.large_string())
    whole = [dict(enumerate(langid._grams(texts.slice(i, 1)))) for i in range(len(texts))]
    for order, (feature, counts) in enumerate(langid._grams(texts)):
        ends = np.cumsum(counts)
        for i in range(len(texts)):
            assert feature[ends[i] - counts[i] : ends[i]].tolist() == whole[i][order][0].tolist()


# quality


def shout(rng):
    return " ".join(rng.choice(LANGUAGES["aa"]).upper() + "!!" for _ in range(40))


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0 or (i % 10 == 3 and i < 200)
        rows.append((i, shout(rng) if bad else sentence(rng, LANGUAGES["aa"], 40) + ".", "hot" if i < 200 else f"h{i % 7}", "en" if i % 2 else None, "x", 1.0))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(500, None, None, None, "x", 0.0), (501, "", "h1", "en", "x", 0.0), (1, rows[1][1], "hot", "en", "x", 0.0), (None, "Of the thing and this.", "new", "en", "x", 0.0)]
    labels += [(1, 1, 0), (None, 1, 0), (3, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, host string, evidence double").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_posterior_by_hand(graded, spark):
    docs, labels = graded
    classifier = quality.fit_classifier(docs, labels)
    found = quality.posterior(docs, classifier, docs["source"], docs["lang"]).collect()
    assert len(found) == docs.count()
    texts = pa.array([r["doc"]["text"] or "" for r in found], pa.large_string())
    evidence = classifier.evidence(texts)
    assert np.allclose([r["evidence"] for r in found], evidence)
    chance = 1 / (1 + np.exp(-(evidence + classifier.base)))
    hosts, paths = {}, {}
    for r, p in zip(found, chance, strict=True):
        hosts.setdefault(r["doc"]["source"], []).append(p)
        paths.setdefault((r["doc"]["source"], r["doc"]["lang"]), []).append(p)
    overall = chance.mean()

    def strength(groups):
        n, good, prior = (np.asarray(x, float) for x in zip(*groups, strict=True))
        spread = prior * (1 - prior)
        seen, by_chance, more = (n * (good / n - prior) ** 2).sum(), spread.sum(), ((n - 1) * spread).sum()
        return quality.STRONGEST if seen <= by_chance else min(quality.STRONGEST, max(quality.WEAKEST, more / (seen - by_chance) - 1))

    s_host = strength([(len(x), sum(x), overall) for x in hosts.values()])
    host = {h: (sum(x) + s_host * overall) / (len(x) + s_host) for h, x in hosts.items()}
    s = strength([(len(x), sum(x), host[h]) for (h, _), x in paths.items()])
    for r, e, c in zip(found, evidence, chance, strict=True):  # sites without the document itself
        here, there = paths[r["doc"]["source"], r["doc"]["lang"]], hosts[r["doc"]["source"]]
        others = (chance.sum() - c) / (len(chance) - 1)
        of_host = (sum(there) - c + s_host * others) / (len(there) - 1 + s_host)
        own = (sum(here) - c + s * of_host) / (len(here) - 1 + s)
        p = 1 / (1 + np.exp(-(np.log(own / (1 - own)) + e)))
        assert (r["host_good"], r["path_good"], r["p_good"]) == pytest.approx((of_host, own, p), rel=1e-5)
        assert r["p_harm"] == 0 and r["keep"] == (r["p_good"] >= 0.5)
        if r["doc"]["text"]:
            assert r["keep"] == (not r["doc"]["text"].isupper())


def test_words_tell_harm(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        text = sentence(rng, LANGUAGES["aa"], 30)
        bad = i % 2 == 0
        rows.append((i, text + (f" You {rng.choice(['Scum', 'LOSER'])}!" if bad else " You friend!"), "h", "en"))
        labels.append((i, 1, int(bad)) if i < 200 else (i, 1, None))
    rows += [(900, None, None, None), (901, "", "h", "en"), (902, "scum " * 400_000, "h", "en"), (903, "scumbag", "h", "en")] + rows[:2]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    graded = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    harm = quality.fit_words(docs, graded)
    assert {"scum", "loser"} <= set(harm.words) and "you" not in harm.words and "friend" not in harm.words
    n_bad, n_good = 100, 100
    bad = [r[1].lower() for r in rows[:200] if r[0] % 2 == 0]
    a, b = sum("scum" in t for t in bad) + 0.5, 0.5  # by hand
    want = np.log(a / (n_bad + 1)) - np.log(b / (n_good + 1)) - quality.SURE * np.sqrt(1 / a + 1 / b)
    assert harm.weights[harm.words.index("scum")] == pytest.approx(want)
    assert harm.base == pytest.approx(np.log(n_bad / n_good))
    blind = quality.Classifier(np.zeros(quality.N_FEATURES), 0.0)
    found = quality.posterior(docs, blind, docs["source"], docs["lang"], harm=harm).collect()
    assert len(found) == len(rows)
    caught = sorted(r["doc"]["doc_id"] for r in found if r["p_harm"] >= quality.HARMFUL)
    assert caught == sorted(r[0] for r in rows if r[0] == 902 or r[0] < 300 and r[0] % 2 == 0)
    assert all(r["p_harm"] < quality.HARMFUL or not r["keep"] for r in found)
    for none in (graded.filter("toxic = 0"), graded.filter("false")):
        assert quality.fit_words(docs, none).words == ()
    assert quality.fit_words(docs.filter("false"), graded).words == ()


def test_sparse_sites_shrink(spark):
    rows = [("a", 1000, 900.0, 0.5), ("b", 1000, 300.0, 0.5), ("c", 1000, 500.0, 0.5)]
    groups = spark.createDataFrame(rows, "g string, n bigint, good double, p double")
    assert 1 < quality.strength(groups, "n", "good", groups["p"]) < 20
    alike = spark.createDataFrame([("a", 1000, 500.0, 0.5), ("b", 10, 5.0, 0.5)], "g string, n bigint, good double, p double")
    assert quality.strength(alike, "n", "good", alike["p"]) == quality.STRONGEST


def test_quality_without_labels_or_rows(graded):
    docs, labels = graded
    for some in (labels.filter("false"), labels.filter("quality = 1")):
        blind = quality.fit_classifier(docs, some)
        assert {r["evidence"] for r in quality.posterior(docs, blind, docs["source"], docs["lang"]).collect()} == {0.0}
    none = docs.filter("false")
    assert quality.posterior(none, quality.fit_classifier(docs, labels), none["source"], none["lang"]).collect() == []


# repeated passages


def brute_repeats(rows, size):
    seen, out = set(), []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(words)
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone[k : k + size] = [True] * size
            seen.add(window)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((i, len(words), len(words) - len(kept), " ".join(kept)))
    return sorted(out, key=repr)


def repeated_rows(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(37)]
    rows = [(-1, None), (0, ""), (1, " \t\n "), (2, "one"), (3, "x " * 90), (4, "x\x0bx\x0cx " * 30), (5, "a\xa0b é 日本 " * 12), (6, "\x1c \x85 z")]
    for i in range(7, 60):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage[rng.randrange(5) :]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(i, rows[20][1]) for i in range(60, 75)]  # copies
    return rows


@pytest.mark.parametrize(("size", "segments", "depth"), [(20, None, 2), (5, 7, 1), (1, 3, 2)])
def test_repeats(spark, size, segments, depth):
    rows = repeated_rows(size)
    table = table_of(spark, rows)
    found = substring.remove_repeats(table, size=size, segments=segments, depth=depth)
    assert found.columns == ["doc", "n_words", "n_removed", "kept"]
    got = [(r["doc"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()]
    assert sorted(got, key=repr) == brute_repeats(rows, size)


def test_repeats_with_colliding_cells(spark, monkeypatch):
    rows = repeated_rows(9)
    real = substring._cells
    monkeypatch.setattr(substring, "_cells", lambda h, row, segments: real(h, row, segments) & ~0xFFFFFF)  # 4 cells a segment
    found = substring.remove_repeats(table_of(spark, rows), size=4, segments=2)
    got = [(r["doc"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()]
    assert sorted(got, key=repr) == brute_repeats(rows, 4)


def test_repeats_of_rows_with_one_id(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (None, text)]
    got = sorted(r["n_removed"] for r in substring.remove_repeats(table_of(spark, rows)).collect())
    assert got == [0, 30, 30]
    first = [r["doc"]["doc_id"] for r in substring.remove_repeats(table_of(spark, rows)).collect() if not r["n_removed"]]
    assert first == [None]
    assert substring.remove_repeats(table_of(spark, [])).collect() == []


def test_steps_round_trip():
    cells = np.asarray([0, 5, 65539, 65540, 1 << 25, (1 << 26) - 1])
    assert substring._from_steps(substring._steps(cells)).tolist() == cells.tolist()


# near duplicates


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_classes(rows, similarity=0.8, n=5):
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))
    distinct = {}
    for k, s in enumerate(sets):
        distinct.setdefault(s, []).append(k)
    links = dict.fromkeys(distinct, 0)
    keys = [s for s in distinct if s]

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, s in enumerate(keys):
        for k in distinct[s][1:]:
            label[root(k)] = root(distinct[s][0])
        for t in keys[:a]:
            if len(s & t) >= similarity * len(s | t) - 1e-9:
                links[s] += 1
                links[t] += 1
                label[root(distinct[s][0])] = root(distinct[t][0])
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        known = [x for x in least[root(k)] if x is not None]
        out.append((i, min(known) if known else None, links[sets[k]] if sets[k] else 0, len(distinct[sets[k]]) if sets[k] else 1))
    return sorted(out, key=repr)


def near_rows(seed, groups=8, size=12):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(2000)]
    rows = [(None, "a b c d e f g"), (0, None), (1, ""), (2, "one"), (3, "one"), (4, "one two"), (5, " one  two\n"), (6, "a b c d e f g"), (7, "a b c d e a b c d e"), (8, "  ")]
    i = 9
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((i, " ".join(copy)))
            i += 1
    rows += [(i + k, rows[12][1]) for k in range(20)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes(spark, seed):
    rows = near_rows(seed)
    found = chosen_path.jaccard_classes(table_of(spark, rows)).collect()
    got = [(r["doc"]["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in found]
    assert sorted(got, key=repr) == brute_classes(rows)
    kept = [r for r in found if r["keep"]]
    assert len(kept) == len({(r["class_id"], r["doc"]["text"] if r["class_id"] is None else 0) for r in found})
    assert all(r["doc"]["doc_id"] == r["class_id"] for r in kept)


def test_large_groups_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", 4)
    monkeypatch.setattr(chosen_path, "TILE", 8)
    monkeypatch.setattr(chosen_path, "LEVELS", 3)
    monkeypatch.setattr(chosen_path, "TASK_SHINGLES", 500)
    monkeypatch.setattr(chosen_path, "TASK_ROWS", 10)
    rows = near_rows(3, groups=3, size=40)
    got = [(r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in chosen_path.membership(chosen_path.jaccard_classes(table_of(spark, rows))).collect()]
    assert sorted(got, key=repr) == brute_classes(rows)


def test_classes_of_nothing(spark):
    assert chosen_path.jaccard_classes(table_of(spark, [])).collect() == []
    alone = chosen_path.jaccard_classes(table_of(spark, [(3, None)], 1)).collect()
    assert [(r["class_id"], r["n_links"], r["n_copies"], r["keep"]) for r in alone] == [(3, 0, 1, True)]


def test_recall_at_the_least_similarity():
    """Pairs of sets just at the similarity nearly all meet in some node of some run."""
    assert chosen_path.runs_for(0.999, 1) == 7 and chosen_path.runs_for(0.999, 3) == 15
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(400):
        both = rng.integers(0, 2**63, 80).astype(np.uint64)
        sets += [np.sort(np.concatenate([both, rng.integers(0, 2**63, 10).astype(np.uint64)])) for _ in range(2)]
    tokens = chosen_path.sketches(np.concatenate(sets), np.full(800, 90)).reshape(400, 2, -1)
    equal = (tokens[:, 0] == tokens[:, 1]).mean(axis=1)
    assert abs(equal.mean() - 0.8) < 0.01
    least = np.floor(64 * 0.8 - chosen_path.SLACK * np.sqrt(64 * 0.8 * 0.2)) / 64
    assert (equal >= least).mean() > 0.997


def test_components(spark):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7)]
    label = {x: x for p in pairs[:-1] for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs[:-1]:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    found = {r["node"]: r["label"] for r in chosen_path.components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    alone = {x for a, b in pairs if a == b for x in (a,) if all(a not in p for p in pairs if p[0] != p[1])}
    assert found == {k: v for k, v in label.items() if k not in alone and any(k in p and p[0] != p[1] for p in pairs)}
    assert chosen_path.components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_recall_in_families_larger_than_a_leaf(spark, monkeypatch):
    """Members share half of a template's tokens without being alike, so nodes are split beyond ``depth``.

    One pair of each family is alike, by tokens of the template alone, which no early split gives a node of its own.
    """
    monkeypatch.setattr(chosen_path, "LEAF", 2)
    rng = np.random.default_rng(11)
    families, size, places = 60, 64, chosen_path.PLACES
    fresh = rng.integers(1 << 20, 1 << 30, (families, size, places))
    template = rng.integers(1, 1 << 20, (families, 1, places))
    held = rng.random((families, size, places)) < 0.5
    held[:, :2] = rng.random((families, 1, places)).argsort(axis=2) < 52  # just above the similarity
    tokens = np.where(held, template, fresh).reshape(-1, places)
    reps = spark.createDataFrame([(i, row) for i, row in enumerate(tokens.tolist())], "rep bigint, sketch array<int>").repartition(4)
    found = chosen_path._candidates(reps, 0.8, places, recall=0.95, depth=1)
    label = {r["node"]: r["label"] for r in chosen_path.components(found).collect()}
    met = [i in label and label[i] == label.get(i + 1) for i in range(0, families * size, size)]
    assert np.mean(met) >= 0.95


def test_plans_do_not_grow_with_levels(spark, monkeypatch):
    """The driver holds all stages of a plan at once, so those of all levels of all runs must not be one plan."""
    monkeypatch.setattr(chosen_path, "LEAF", 8)
    rng = np.random.default_rng(13)
    family, others, places = 100, 200, chosen_path.PLACES
    template = rng.integers(1, 1 << 20, places)
    held = rng.random((family + others, places)) < np.where(np.arange(family + others) < family, 0.93, 0.75)[:, None]
    tokens = np.where(held, template, rng.integers(1 << 20, 1 << 30, held.shape))
    reps = spark.createDataFrame([(i, row) for i, row in enumerate(tokens.tolist())], "rep bigint, sketch array<int>").repartition(4)
    exchanges, real = {}, chosen_path.staged
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange")

    def staged(df, name):
        exchanges.setdefault(name, []).append(count(df))
        return real(df, name)

    monkeypatch.setattr(chosen_path, "staged", staged)
    found = chosen_path._candidates(real(reps, "reps"), 0.8, places, 0.999, 3)
    assert len(exchanges["nodes"]) >= 6  # levels of both calls
    assert max(n for name, counts in exchanges.items() if name != "links" for n in counts) <= 4 and count(found) == 0
    label = {r["node"]: r["label"] for r in chosen_path.components(found).collect()}
    assert len({label[i] for i in range(family)}) == 1


def test_runs_for_a_sketch_of_tokens():
    """Tokens that are equal by chance vary, which takes a few more runs than their mean does; deeper nodes take more."""
    sizes = [chosen_path.runs_for(0.999, d, 64) for d in range(1, 9)]
    assert sizes == sorted(sizes) and all(n >= chosen_path.runs_for(0.999, d) for d, n in enumerate(sizes, 1))
    assert chosen_path.runs_for(0.999, 8) == 33


def test_a_large_group_is_not_split_for_a_few_others(spark, monkeypatch):
    """A family of near copies and a few that share half of its tokens: once the family is known, its nodes are settled at once."""
    monkeypatch.setattr(chosen_path, "LEAF", 64)
    rng = np.random.default_rng(12)
    family, others, places = 600, 24, chosen_path.PLACES
    template = rng.integers(1, 1 << 20, places)
    fresh = rng.integers(1 << 20, 1 << 30, (family + others, places))
    held = rng.random((family + others, places)) < np.where(np.arange(family + others) < family, 0.93, 0.5)[:, None]
    tokens = np.where(held, template, fresh)
    tokens[family + 1 :: 2] = np.where(rng.random((others // 2, places)) < 0.9, tokens[family::2], fresh[family + 1 :: 2])  # pairs
    reps = spark.createDataFrame([(i, row) for i, row in enumerate(tokens.tolist())], "rep bigint, sketch array<int>").repartition(4)
    written, real, some = [], chosen_path.staged, chosen_path._some_runs

    def staged(df, name):
        found = real(df, name)
        if name == "paths":
            written[-1].append(found.count())
        return found

    def some_runs(*args, **named):
        written.append([])
        return some(*args, **named)

    monkeypatch.setattr(chosen_path, "staged", staged)
    monkeypatch.setattr(chosen_path, "_some_runs", some_runs)
    found = chosen_path._candidates(reps, 0.8, places, 0.999, 3)
    label = {r["node"]: r["label"] for r in chosen_path.components(found).collect()}
    assert len(written) > 1 and sum(n for runs in written[1:] for n in runs[1:]) < family
    assert len({label[i] for i in range(family)}) == 1
    assert all(label[i] == label[i + 1] for i in range(family, family + others, 2))
