"""Near duplicates, lines, mixing, toxicity, preferences, search and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairclf.llm import near_duplicates as nd
from pairclf.llm import top_k as tk
from pairclf.llm.components import components
from pairclf.llm.line_templates import alike, drop_recurring_lines
from pairclf.llm.mixing import mix, route, source_targets
from pairclf.llm.preferences import conversations, format_preferences, with_foreign_replies, with_next
from pairclf.llm.toxicity import Lexicon, Model, edits_allowed, features, labelled_sample, learn_lexicon, score, stem_edits

SF_DIR = "/root/testdata/sf0.001"


def words(count, seed):
    return [f"w{random.Random(seed * 1000 + i).randrange(5000)}" for i in range(count)]


def letters(count, seed):
    """Words without digits, which would be fields."""
    return [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words(count, seed)]


def plain_similarity(a, b):
    bags = []
    for text in (a, b):
        w = text.lower().split()
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else []))
    x, y = bags
    both = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in both) for i in x if i in y)


def plain_classes(texts):
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and plain_similarity(texts[i], texts[j]) >= 0.8 - 1e-12:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def near_texts():
    """A chain of texts, each near the next only; copies; a group around a base; unlike texts."""
    random.seed(5)
    texts, number = {}, 0
    base = words(120, 1)
    for step in range(8):  # a chain: one edit more each time
        base = list(base)
        base[13 * step + 3] = f"edit{step}"
        texts[number] = " ".join(base)
        number += 1
    group = words(150, 2)
    for _ in range(40):
        edited = list(group)
        for _ in range(random.randint(0, 6)):
            edited[random.randrange(len(edited))] = f"x{random.randrange(10**6)}"
        texts[number] = " ".join(edited)
        number += 1
    for i in range(5):
        texts[number] = " ".join(words(80, 10 + i))
        texts[number + 1] = texts[number].upper()
        number += 2
    texts[number] = "one two"
    texts[number + 1] = "one  two"
    return texts


def test_near_duplicate_classes_equal_plain_ones(spark):
    texts = near_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(df).collect()}
    assert got == plain_classes(texts)


def test_cells_of_several_blocks_find_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_ROWS", 7)
    texts = near_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"]: r["class_id"] for r in nd.near_duplicate_classes(df).collect()} == plain_classes(texts)


def test_registers_agree_with_the_probability_of_the_similarity():
    a = " ".join(words(300, 3))
    b = " ".join(words(300, 3)[:270] + words(30, 4))
    document, shingle, weight, _ = nd.shingle_bags([a + " " + a[:400], b])
    held = nd.signatures(2, document, shingle, weight, registers=20_000)
    assert abs((held[0] == held[1]).mean() - plain_similarity(a + " " + a[:400], b)) < 0.02
    bags = [(shingle[document == i], weight[document == i]) for i in range(2)]
    assert abs(nd.probability_jaccard(*bags) - plain_similarity(a + " " + a[:400], b)) < 1e-9


def test_an_id_with_several_texts_links_their_classes(spark):
    base = {c: " ".join(words(60, seed)) for c, seed in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5))}
    near = {c: text + " and one more" for c, text in base.items()}
    rows = [(1, base["a"]), (1, base["b"]), (2, near["b"]), (3, near["a"]), (4, base["c"]), (5, near["c"])]
    rows += [(9, base["d"]), (9, base["d"]), (7, base["e"]), (9, base["e"]), (8, ""), (8, base["c"]), (None, base["a"]), (None, base["a"])]
    got = nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got if r["doc_id"] is not None)) == [
        (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 7), (8, 4), (8, 4), (9, 7), (9, 7), (9, 7)
    ]
    assert sum(r["doc_id"] is None for r in got) == 2


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_recurring_lines_go_and_copies_stay(spark):
    passage = " ".join(letters(60, 7))
    own = [[" ".join(letters(12, 100 * i + k)) for k in range(4)] for i in range(6)]
    rows = [(i, "\n".join([own[i][0], own[i][1], passage, own[i][2], own[i][3]])) for i in range(4)]
    rows += [(4, "\n".join(own[4])), (5, "\n".join(own[4])), (6, "\n".join([*own[4][:3], "a new last line here"]))]
    logs = [(20 + i, "\n".join([" ".join(letters(12, 800 + i)), f"user {i}{i} logged in from host {i * 7}", " ".join(letters(9, 850 + i))])) for i in range(4)]
    names = ["ann", "bob", "cid", "dan", "eve"]
    logs += [(30 + i, f"first {n} line {n} of text\nthe new user {n} came in today at noon\nlast {n} line {n} of it") for i, n in enumerate(names)]
    table = [(40 + i, f"{' '.join(letters(9, 900 + i))}\n{i} {i}1 {i}2 {i}3 5 6\n{' '.join(letters(9, 950 + i))}") for i in range(4)]
    df = spark.createDataFrame(rows + logs + table, "doc_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()}
    assert cut[0] == rows[0][1]  # the first occurrence stays
    for i in (1, 2, 3):
        assert cut[i] == "\n".join(own[i])
    assert all(cut[i] == dict(rows)[i] for i in (4, 5, 6))  # copies are not recurring lines
    assert all(cut[i] == text for i, text in table)  # rows of numbers are no template
    assert "logged in" in cut[20] and all("logged in" not in cut[20 + i] for i in (1, 2, 3))
    assert "came in" in cut[30] and all("came in" not in cut[30 + i] for i in range(1, 5))


def test_passages_of_many_lines_go_from_unlike_hosts_only(spark):
    def own(i, count=4):
        return [" ".join(letters(12, 3000 + 20 * i + k)) for k in range(count)]

    two, five = ([" ".join(letters(10, seed + k)) for k in range(n)] for seed, n in ((5000, 2), (5100, 5)))
    hosts = [(i, own(i)) for i in range(6)]
    rows = [(i, [*o[:2], *(two if i < 3 else five), *o[2:]]) for i, o in hosts]
    logs = [(10 + i, [*own(10 + i), f"user {i}{i} logged in from host {i * 7}", f"user {i}{i} then left the host {i * 7}"]) for i in range(3)]
    # Near copies with a word changed in most lines, all with a passage that one other text has.
    shared = [" ".join(letters(10, 5200 + k)) for k in range(3)]
    base = own(30, 12)
    near = [(20 + n, [*shared, *[f"{line[: line.rindex(' ')]} changed{n}" if k % 4 else line for k, line in enumerate(base)]]) for n in range(8)]
    other = [(40, [*own(40), *shared, *own(41)])]
    every = {i: "\n".join(lines) for i, lines in rows + logs + near + other}
    df = spark.createDataFrame(list(every.items()), "doc_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()}
    for i in (0, 3, 10, 20):  # the first hosts
        assert cut[i] == every[i]
    for i in (1, 2, 4, 5):
        assert cut[i] == "\n".join(hosts[i][1])
    for i in (11, 12):
        assert cut[i] == "\n".join(own(i))
    assert cut[40] == "\n".join([*own(40), *own(41)])
    for i, lines in near[1:]:  # the passage goes, what only copies share stays
        assert cut[i] == "\n".join(lines[3:])


def test_passages_go_from_pages_that_consist_of_them(spark):
    passage = [" ".join(letters(9, 8000 + k)) for k in range(30)]
    own = {i: [" ".join(letters(9, 8100 + 20 * i + k)) for k in range(10)] for i in range(10)}
    rows = [(i, "\n".join([*o[:5], *passage, *o[5:]])) for i, o in own.items()]
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert cut[0] == rows[0][1] and all(cut[i] == "\n".join(own[i]) for i in range(1, 10))


def test_many_near_copies_lose_nothing(spark):
    rng = random.Random(9)
    base = [letters(12, 9000 + k) for k in range(30)]
    rows = []
    for i in range(200):
        text = [list(line) for line in base]
        for line in rng.sample(text, 24):  # a word changed in four of five lines
            line[rng.randrange(12)] = f"edited{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]}{'ab'[i // 100]}"
        rows.append((i, "\n".join(map(" ".join, text))))
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert cut == dict(rows)


def test_short_lines_go_where_many_texts_hold_them(spark):
    rows = [(i, f"{' '.join(letters(9, 9100 + i))}\nall rights reserved\nEnd\n{' '.join(letters(9, 9200 + i))}") for i in range(20)]
    rows += [(30 + i, f"{' '.join(letters(9, 9300 + i))}\nseen by few\n{' '.join(letters(9, 9400 + i))}") for i in range(9)]
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(("reserved" in cut[i]) == (i == 0) and "\nEnd\n" in cut[i] for i in range(20))
    assert all("seen by few" in cut[30 + i] for i in range(9))


def plain_recurring(texts):
    """content -> dropped places, by the module's rule for whole lines that are not generalised."""
    lines = {i: [(at, tuple(x.split())) for at, x in enumerate(t.split("\n")) if x.strip()] for i, t in texts.items()}

    def own(a, b):
        theirs = {x for _, x in lines[b]}

        def parts(x):
            return {("head", x[:3]), ("tail", x[-3:]), ("body", x[3:-3] if len(x) > 6 else x)}

        known = {p for x in theirs for p in parts(x)}
        return sum(len(x) for _, x in lines[a] if x not in theirs and not parts(x) & known)

    hosts = defaultdict(set)
    for i, rows in lines.items():
        for _, x in rows:
            if len(x) > 1:
                hosts[x].add(i)
    dropped = defaultdict(set)
    for x, ids in hosts.items():
        if len(ids) < (10 if len(x) < 4 else 2):
            continue
        first = min(ids)
        for i in ids - {first}:
            a, b = own(i, first), own(first, i)
            sizes = [sum(len(y) for _, y in lines[k]) for k in (i, first)]
            if sum(sizes) - a - b < 0.5 * sum(sizes) or (a >= 0.2 * sizes[0] and b >= 0.2 * sizes[1]):
                break
        else:
            continue
        stays = min(at for at, y in lines[first] if y == x)
        for i in ids:
            dropped[i] |= {at for at, y in lines[i] if y == x and (i, at) != (first, stays)}
    return {i: "\n".join(y for at, y in enumerate(t.split("\n")) if at not in dropped[i]) for i, t in texts.items()}


def test_texts_are_compared_as_by_a_plain_version(spark, monkeypatch):
    from pairclf.llm import line_templates as lt

    monkeypatch.setattr(lt, "LOG_TOKENS", 0)  # whole lines only
    rng = random.Random(11)
    pool = [letters(rng.randrange(2, 9), 9500 + k) for k in range(60)]
    texts = {}
    for i in range(150):
        if i % 3 == 2:  # a near copy of an earlier text
            text = [list(line) for line in texts[rng.randrange(i)]]
            for line in rng.sample(text, len(text) // 2):
                line[rng.randrange(len(line))] = f"other{'abcdefghij'[i % 10]}{'abcdefghijklmno'[i // 10]}"
        else:
            text = [list(line) for line in rng.sample(pool, rng.randrange(1, 6))]
            text += [letters(rng.randrange(2, 9), 20_000 + 10 * i + k) for k in range(rng.randrange(4))]
        texts[i] = text
    whole = {i: "\n".join(map(" ".join, t)) for i, t in texts.items()}
    whole = {i: t for i, t in whole.items() if list(whole.values()).index(t) == i}  # copies are one text
    df = spark.createDataFrame(list(whole.items()), "doc_id bigint, text string").repartition(5)
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()}
    assert cut == plain_recurring(whole) and sum(cut[i] != whole[i] for i in whole) > 20


def test_a_leaf_holds_several_templates_among_prose(spark):
    kinds = ["was moved from {} to the main store", "has left for {} and will return soon", "could not find {} in any open list"]
    names = ["ann", "bob", "cid"]
    bodies = [f"then the clerk {kind.format(n)}" for kind in kinds for n in names]
    bodies += [f"every old ship from {n} must wait outside" for n in names[:2]]
    bodies += [f"then the clerk {' '.join(letters(8, 7000 + i))}" for i in range(20)]
    rows = [(i, f"{' '.join(letters(12, 7100 + i))}\n{body}\n{' '.join(letters(12, 7200 + i))}") for i, body in enumerate(bodies)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()}
    firsts = (0, 3, 6, 9)
    for i, text in rows:
        own = text.split("\n")
        assert cut[i] == (text if i in firsts or i > 10 else "\n".join([own[0], own[2]]))


def test_long_lines_are_generalised(spark):
    names = ["ann", "bob", "cid"]
    kinds = [letters(60, 7300), letters(300, 7310)]
    rows = []
    for i, n in enumerate(names):
        body = [" ".join([*k[:20], n, *k[20:]]) for k in kinds]
        rows.append((i, "\n".join([" ".join(letters(200, 7400 + i)), *body, " ".join(letters(200, 7500 + i))])))
    cut = {r["doc_id"]: r["text"] for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert cut[0] == rows[0][1]
    for i in (1, 2):
        own = rows[i][1].split("\n")
        assert cut[i] == "\n".join([own[0], own[-1]])


def agree(a, b):
    """Whether two lines of a leaf agree in enough places."""
    same = [x == y != "<*>" for x, y in zip(a, b)]
    return sum(same) >= 0.6 * len(a) and 2 * sum(same[3:]) >= len(a) - 3


@pytest.mark.parametrize("direct", [64, 0])
def test_no_line_that_agrees_with_another_is_left_alone(spark, monkeypatch, direct):
    from pairclf.llm import line_templates as lt

    monkeypatch.setattr(lt, "DIRECT", direct, raising=False)
    rng = random.Random(13)
    lines = set()
    for leaf, size, pool in (("a", 12, 3), ("b", 13, 4), ("c", 9, 2), ("d", 16, 12)):
        for _ in range(60):
            rest = [f"{w}{rng.randrange(pool)}".replace("0", "z") for w in letters(size - 3, 7700 + size)]
            lines.add((leaf, "the", "<*>" if leaf == "b" else "old", *rest))
    # Pairs that agree in places that many other lines share, but few of those with each other.
    lines = sorted(lines)
    rows = [(ord(x[0]), n, list(x)) for n, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "leaf bigint, line bigint, tokens array<string>").repartition(5)
    found = [(r["line"], r["template"]) for r in lt.generalised(df).collect()]
    template = dict(found)
    assert len(template) == len(found)
    alike = {n: [m for m, y in enumerate(lines) if m != n and len(x) == len(y) and x[:3] == y[:3] and agree(x, y)] for n, x in enumerate(lines)}
    assert any(alike.values()) and not all(alike.values())
    for n, others in alike.items():
        assert any(template.get(n) == template.get(m) is not None for m in others) if others else n not in template


@pytest.mark.parametrize("direct", [64, 0])
def test_no_line_with_a_like_is_missed(spark, monkeypatch, direct):
    from pairclf.llm import line_templates as lt

    monkeypatch.setattr(lt, "DIRECT", direct)
    rng = random.Random(14)
    held = {n: sorted(rng.sample(range(n % 2 * 18, n % 2 * 18 + 18), rng.randrange(7, 11))) for n in range(160)}
    own = [(n % 2, n, 7, places, 0) for n, places in held.items()]
    links = lt.alike(
        spark.createDataFrame(own, "leaf bigint, line bigint, need int, places array<bigint>, weight bigint").repartition(3),
        spark.createDataFrame([(n,) for n in held if n % 3], "line bigint"),
    )
    found = {(r["line"], r["other"]) for r in links.collect()}
    true = {(a, b) for a in held for b in held if a % 2 == b % 2 and a != b and len({*held[a]} & {*held[b]}) >= 7}
    assert found <= true
    assert {n for link in found for n in link if n % 3} == {n for n, _ in true if n % 3}


def test_the_search_of_lines_starts_no_python(spark, monkeypatch):
    rows = [(i, f"{letters(1, 900 + i)[0]} user number {i} logged in from host {letters(1, 950 + i)[0]}") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()}

    def refused(*arguments, **named):
        raise AssertionError("rows made in Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    own = df.select(
        F.col("doc_id").alias("line"), F.lit(0).cast("bigint").alias("leaf"), F.lit(1).alias("need"),
        F.array(F.lit(7).cast("bigint")).alias("places"), F.col("doc_id").alias("weight"),
    )
    links = alike(own, own.filter("line < 3").select("line"))
    assert dict(links.dtypes) == {"line": "bigint", "other": "bigint"}
    assert {line for r in links.collect() for line in r} == {0, 1, 2, 7}
    assert alike(own, own.filter("line < 0").select("line")).count() == 0
    assert {r["doc_id"]: r["text"] for r in drop_recurring_lines(df).collect()} == expected


def test_lines_are_split_as_by_the_pattern_and_texts_once(spark):
    from pairclf.llm import line_templates as lt

    bodies = ["one two", " one  two\t", "one\ttwo\x0bthree", "\x0b\x0cone\rtwo\r", "\r", "a\u00a0b c", "\u3000x y", " \t ", "so x1 two  we", "7 8 9", "7  8\t9"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id bigint, raw string")
    found = {r["id"]: r["tokens"] for r in lt._with_tokens(df).collect()}
    expected = {i: re.split("[ \t\x0b-\r]+", b.strip(" \t\x0b\x0c\r")) for i, b in enumerate(bodies) if b.strip(" \t\x0b\x0c\r")}
    expected[8] = ["so", "<*>", "two", "we"]
    assert found == expected
    plan = lt._lines(df, "id", "raw")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(", \n, -1)") == 1


def test_targets_fill_up_to_the_limit_and_share_the_excess():
    targets = source_targets({"a": 10, "b": 1000, None: 1000}, (3, 1, 2), 150, 2)
    assert targets["a"] == 20 and sum(targets.values()) == 3015
    assert targets[None] == 2 * targets["b"]


def test_flow_repeats_no_word_while_another_is_untaken():
    capacity = {("a",): 10, ("a", "b"): 10, ("b",): 2}
    flow = route(capacity, {"a": 10, "b": 12}, 2)
    assert flow == {(("a",), "a"): 10, (("a", "b"), "b"): 10, (("b",), "b"): 2}
    flow = route(capacity, {"a": 22, "b": 12}, 2)
    into = {s: sum(v for (_, t), v in flow.items() if t == s) for s in "ab"}
    assert into == {"a": 22, "b": 12}
    for pattern, size in capacity.items():
        assert sum(v for (p, _), v in flow.items() if p == pattern) <= 2 * size


def test_mix_of_overlapping_sources_meets_the_quotas(spark):
    rows = [(i, "w " * (i % 7 + 1), ["a", "b", None][i % 3], ["a", "b"][i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, s string, t string")
    mixed = mix(df, F.array("s", "t"), (1,), 60, 2).collect()
    assert len(mixed) == 300 and all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    again = mix(df.repartition(5), F.array("s", "t"), (1,), 60, 2).collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in mixed}


def distance(a, b):
    """Insertions, deletions, other letters and exchanges of neighbours that lead from a to b."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def stem_distance(word, stem):
    """The least distance of a beginning of the word whose last letter is in its place."""
    found = [99]
    for n in range(1, len(word) + 1):
        if word[n - 1] == stem[-1]:
            found.append(distance(word[: n - 1], stem[:-1]))
        if n > 1 and word[n - 2 : n] == stem[:-3:-1] and word[n - 2] != word[n - 1]:
            found.append(distance(word[: n - 2], stem[:-2]) + 1)
    return min(found)


@pytest.mark.parametrize("stems", [(), ("idiot", "worthles"), ("scum", "patheti", "worthlessne", "pathos")])
def test_automaton_finds_terms_within_the_edits(stems):
    terms = [(t, False, 3.0 + n) for n, t in enumerate(["idiot", "worthless", "scum", "pathetic"]) if t not in stems]
    terms += [(t, True, 5.0 + n) for n, t in enumerate(stems)]
    lexicon = Lexicon(terms)
    rng = random.Random(6)
    for _ in range(4000):
        word = list(rng.choice(terms)[0])
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "i", "s", "t"])
            if rng.random() < 0.4 and len(word) > 1:
                at = rng.randrange(len(word) - 1)
                word[at : at + 2] = word[at : at + 2][::-1]
        word = "".join(word) + rng.choice(["", "", "ness", "ic"])
        near = []
        for number, (letters, stem, odds) in enumerate(terms):
            if (d := distance(word, letters)) <= min(edits_allowed(len(letters)), edits_allowed(len(word))):
                near.append((d, -odds, number))
            if stem and (d := stem_distance(word, letters)) <= stem_edits(len(letters)):
                near.append((d, -odds, number))
        assert lexicon.match(word) == ((min(near)[2], min(near)[0]) if near else (-1, 0)), word


def test_misspelled_stems_are_found_and_other_words_are_not():
    lexicon = Lexicon([("idiot", True, 5.0), ("worthles", True, 4.0), ("stupi", True, 3.0)])
    assert lexicon.match("idiotically") == (0, 0) and lexicon.match("worthlessness") == (1, 0)
    assert lexicon.match("idoit") == lexicon.match("idlot") == (0, 1)
    assert lexicon.match("wrothlessness") == lexicon.match("worhlessness") == (1, 1)
    for word in ("studies", "studio", "idiom's", "worth", "patriot"):
        assert lexicon.match(word)[0] < 0


def test_words_stay_beside_the_stem_that_covers_them():
    counts = {"mor*": [0, 60], "moron": [0, 50], "moro*": [0, 55], "morning": [50, 5], "rare": [0, 3]}
    terms = {(t, stem) for t, stem, _ in learn_lexicon(counts, [100, 100]).terms}
    assert terms == {("mor", True), ("moron", False)}


def test_hits_are_counted_without_a_limit(spark):
    df = spark.createDataFrame([(1, "idiot " * 5000 + 'he said "idiot"'), (2, "calm"), (3, None)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in score(df, Model([("idiot", False, 5.0)], [-1.0] + [0.1] * 7)).collect()}
    assert [(rows[i]["abuse"], rows[i]["quotation"]) for i in (1, 2, 3)] == [(4995, 6), (0, 0), (0, 0)]  # five words before "said"


def test_sample_has_no_more_rows_than_its_limit(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i // 2}") for i in range(400)], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, t) for i in (0, 1, 2) for t in (0, 1, 1)], "doc_id bigint, toxic int")
    usable = [i for i in (0, 1, 2) if zlib.crc32(str(i).encode()) % 4 != 2]
    whole = {(f"text {i // 2}", i % 3, t) for i in range(400) if i % 3 in usable for t in (0, 1)}
    assert labelled_sample(docs, labels).count() == len(whole)
    first = sorted(map(tuple, labelled_sample(docs, labels, 10).collect()))
    assert len(first) == 10 and first == sorted(map(tuple, labelled_sample(docs.repartition(7), labels, 10).collect()))


def test_quoted_terms_are_no_abuse():
    lexicon = Lexicon([("idiot", False, 5.0)])
    assert features(lexicon, "you are an idiot today")[1] > 0
    for text in ('he called me an "idiot" today', "she said idiot to him", "the word idiot is rude"):
        x = features(lexicon, text)
        assert x[1] == 0 and x[4] > 0


def test_toxicity_on_held_out_rows(spark):
    from pairclf.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op7_toxicity"](spark, sf_dir).join(labels, "doc_id").filter("held_out").toPandas()
    toxic, clean = rows[rows.toxic == 1], rows[rows.toxic == 0]
    auc = np.mean([(clean.score < s).mean() + 0.5 * (clean.score == s).mean() for s in toxic.score])
    assert auc > 0.9 and (clean.predicted == 0).mean() > 0.98


def test_preferences_share_the_longest_prefix(spark):
    turn = "array<struct<role: string, text: string>>"
    rows = [
        (1, [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "good")], [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "bad")]),
        (2, [("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "a"), ("user", "more")]),
        (3, [("user", "x")], [("user", "y")]),
        (4, [("user", "same")], [("user", "same")]),
        (5, [], []),
    ]
    got = {r["id"]: r for r in format_preferences(spark.createDataFrame(rows, f"id int, chosen {turn}, rejected {turn}")).collect()}
    assert [got[i]["prefix_turns"] for i in range(1, 6)] == [3, 2, 0, 1, 0]
    assert got[1]["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|user|>\nr<|end|>\n"
    assert [tuple(s) for s in got[1]["rejected"]] == [("<|assistant|>\n", False), ("bad<|end|>\n", True)]
    assert got[2]["chosen"] == [] and [s["train"] for s in got[2]["rejected"]] == [False, False]


@pytest.mark.parametrize("ids", [[], [4], range(-6, 40, 2), range(25)])
def test_every_conversation_with_a_reply_makes_a_pair(spark, ids):
    rng = random.Random(5)
    chats = {i: [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None])) for _ in range(rng.randrange(1, 8))] for i in ids}
    chats |= {4: [("user", "q"), ("assistant", "a"), ("user", "end")]} if 4 in chats else {}
    rows = [(i, at, *turn) for i, turns in chats.items() for at, turn in enumerate(turns)] + [(None, 0, "assistant", "none")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").repartition(5)
    replied = df.filter("role = 'assistant' AND conv_id IS NOT NULL").selectExpr("conv_id AS id").distinct()
    pairs = with_foreign_replies(conversations(df), with_next(replied), F.col("id"))
    got = {r["id"]: [[tuple(t) for t in r[side]] for side in ("chosen", "rejected")] for r in pairs.collect()}
    plain = {i: [(role or "user", text or "") for role, text in turns] for i, turns in chats.items()}
    places = {i: [at for at, (role, _) in enumerate(plain[i]) if role == "assistant"] for i in sorted(plain)}
    order = [i for i in places if places[i]]
    expected = {}
    for i, following in zip(order, order[1:] + order[:1]):
        parts_at = places[i][i % len(places[i])]
        expected[i] = [plain[i], plain[i][:parts_at] + plain[following][places[following][-1] :]]
    assert got == expected and len(got) == len(order)


@pytest.mark.parametrize("tiles", [(3, 5), (2048, 8192)])
def test_top_k_with_many_tiles_and_ties(spark, monkeypatch, tiles):
    monkeypatch.setattr(tk, "QUERY_TILE", tiles[0])
    monkeypatch.setattr(tk, "CANDIDATE_TILE", tiles[1])
    random.seed(8)
    vectors = {i: [random.choice([-1.0, 0.0, 0.5]) for _ in range(3)] for i in range(160)}
    vectors |= {1000 + i: [0.5, 0.5, 0.5] for i in range(60)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(7)
    got = defaultdict(list)
    for r in tk.top_k(df, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors.items()}
    for q in [i for i in vectors if i % 10 == 0]:
        best = sorted(((int(whole[q] @ whole[i]), i) for i in vectors if i != q), key=lambda x: (-x[0], x[1]))[:10]
        assert got[q] == best


def test_repeated_queries_and_candidates_lose_no_place(spark):
    rows = [(0, [1.0, 0.0])] * 3 + [(0, [0.0, 1.0])] + [(i, [float(i), -float(i)]) for i in range(1, 15)] + [(14, [14.0, -14.0])] * 2
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in tk.top_k(df, F.col("vec_id") == 0).collect())
    step = 1024 * 1024
    best = [14, 14, 14, 13, 12, 11, 10, 9, 8, 7]
    least = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    want = [(r, i, i * step) for r, i in enumerate(best, 1)] + [(r, i, -i * step) for r, i in enumerate(least, 1)]
    assert got == sorted(want)


def test_large_products_stay_exact(spark):
    df = spark.createDataFrame([(0, [3e9, 1.0]), (1, [1.0, 2.0]), (2, [1.0, 3.0])], "vec_id bigint, embedding array<double>")
    rows = tk.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["score"] for r in rows] == [3 * 10**9 * 2**20 + 3 * 2**20, 3 * 10**9 * 2**20 + 2 * 2**20]


def test_pipeline_keeps_clean_documents_and_takes_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF_DIR).cache()
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and len(after) == len(set(after)) and set(after) <= before
        assert len(after) > 0.8 * len(before)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(set(texts.values())) == len(texts)  # no copies are left
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert out and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out)
    assert {r["doc_id"] for r in out} <= set(texts)
    assert max(Counter(r["doc_id"] for r in out).values()) <= 2
