"""Conversation repair, document fingerprints and ranked search: brute force and odd inputs."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopflow.llm import conversations, fingerprints, lexical, queries
from shopflow.llm.fingerprints import Fingerprint

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Conversations

TURNS = "conv_id long, turn long, role string, text string, _conv string, _pos int, TURNS string"


def turn_table(spark, rows):
    return spark.createDataFrame([(*r, "c", 7, "t") for r in rows], TURNS)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        spaced = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        rest = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        if rest == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", spaced[3])}.get(rest, spaced[3])
        out += [(conv, turn, "user" if rest == 4 else spaced[2], text)] * (2 if rest == 3 else 1)
    return out


def plain_repair(rows):
    """All facts of one conversation's rows by a search over all prefixes, kept whole per state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, counts, faults = set(), Counter(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        faults.append(fault)
    counts["illegal"] = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    # A state is the initials so far, of which only the last and whether there are any matter: "", s, u, a.
    best = {"": (0, "", [])}

    def insert(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                role = "assistant" if state == "u" else "user"
                way = (cost + 5, audit + "I", [*lines, f"{role}:"])
                if role[0] not in table or way[:2] < table[role[0]][:2]:
                    table[role[0]] = way
        return table

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, lines) in insert(best).items():
            ways = [(state, cost + 2, audit + "D", lines)]
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                wanted = "assistant" if state == "u" else "user"
                ways.append((wanted[0], cost + 1 + extra, audit + "R", [*lines, f"{wanted}:{text}"]))
                if role[:1] == wanted[0] or (role[:1] == "s" and state == ""):
                    ways.append((role[0], cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
            for state_after, *way in ways:
                if state_after not in after or tuple(way[:2]) < after[state_after][:2]:
                    after[state_after] = tuple(way)
        best = after
    cost, audit, lines = min((w for s, w in insert(best).items() if s in ("", "a")), key=lambda w: w[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, sha("\n".join(lines))


def plain_report(rows):
    damaged = defaultdict(list)
    for r in plain_damage(rows):
        damaged[r[0]].append(r)
    return sorted(((c, *plain_repair(damaged[c])) for c in {r[0] for r in rows}), key=repr)


def random_turns(seed, conversations_=25):
    random.seed(seed)
    rows = []
    for conv in range(conversations_):
        texts = ["Yes.", "No!", "cut off", " ", "", "Why?", "One more. ", "é!", None]
        for turn in range(random.randint(1, 14)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "USER"])
            text = random.choice(texts) if random.random() < 0.5 else f"Text {random.random()}."
            rows += [(conv, None if random.random() < 0.05 else turn * random.choice([1, 1, 2]), role, text)] * random.choice([1, 1, 1, 2])
    return rows + [(None, 1, "user", "Hello."), (None, None, None, None)]


@pytest.mark.parametrize(("leaf", "fan"), [(1, 2), (3, 2), (4096, 1024)])
def test_repair_equals_a_plain_search(spark, leaf, fan):
    rows = random_turns(leaf)
    got = conversations.repair_report(turn_table(spark, rows).repartition(5), leaf_rows=leaf, fan=fan).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_report(rows)


def test_one_long_conversation_in_many_leaves(spark):
    random.seed(4)
    rows = [(0, t, random.choice(["user", "assistant", "system"]), random.choice(["Yes.", "cut", f"T{t}.", f"U{t}!"])) for t in range(3000)]
    rows += [(1, 0, "user", "x " * 400_000 + "."), (1, 1, "assistant", "Fine.")]
    got = conversations.repair_report(turn_table(spark, rows), leaf_rows=64, fan=4).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_report(rows)


def test_repaired_turns_are_the_audit_carried_out(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "Are you there?"), (2, 0, "assistant", "Hello."), (3, 0, "x", "")]
    found = conversations.repair(turn_table(spark, rows))
    report = {r["_conv"]: (r.blank, r.duplicate, r.cost, r.audit) for r in found.report.collect()}
    assert report == {1: (0, 1, 3, "KKDR"), 2: (0, 0, 2, "D"), 3: (1, 0, 2, "D")}
    turns = sorted((r["_conv"], r["_pos"], r["_sub"], r.role, r.text, r.edit) for r in found.turns.collect())
    assert turns == [(1, 1, 0, "system", "Be kind.", "K"), (1, 2, 0, "user", "Hi.", "K"), (1, 4, 0, "assistant", "Are you there?", "R")]


def test_repair_of_no_conversations(spark):
    assert conversations.repair_report(turn_table(spark, [])).collect() == []
    # The only turn of conversation 5 at turn 20 is dropped.
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    assert [tuple(r) for r in conversations.repair_report(turn_table(spark, [(5, dropped, "user", "Hi.")])).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", sha(""))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=12), st.integers(1, 5))
def test_sums_of_parts_solve_like_the_whole(codes, size):
    """Solving between the states that a row of leaves gives is solving the whole."""
    if not codes:
        return
    whole_cost, whole = conversations.solve(codes)
    leaves = [codes[i : i + size] for i in range(0, len(codes), size)]
    sums = [conversations.summed([conversations.TURNS[c] for c in leaf]) for leaf in leaves]
    root = conversations.summed(sums)
    entry, cost, path = 0, 0, []
    for leaf, behind in zip(leaves, conversations.crossings(sums, 0, conversations.best_end((root[0][0], root[1][0]))), strict=True):
        spent, part = conversations.solve(leaf, entry, behind)
        cost, path, entry = cost + spent, path + part, behind
    assert (cost, path) == (whole_cost, whole)


# Fingerprints

DOCS = "doc_id long, text string, lang string, _id string, _part int, _GUEST string"


def doc_table(spark, rows):
    return spark.createDataFrame([(*r, "en", "i", 3, "g") for r in rows], DOCS)


def plain_edits(rows):
    """(id, n_chars, edited digest, own text, edited text, next text) in order; equal ids by a hash that the caller avoids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [r[1] or "" for r in rows]
    out = []
    for i, (own, _) in enumerate(rows):
        text, after = texts[i], texts[(i + 1) % len(rows)]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        out.append((own, len(text), sha(changed), text, changed, after))
    return out


def words(n, seed):
    chosen = random.Random(seed)
    return " ".join("".join(chosen.choices("abcdefghij", k=chosen.randint(1, 9))) + chosen.choice(["", "", ".\n"]) for _ in range(n))


FINGERPRINTED = [(i * 3 % 101, words(i % 40 * (i % 7), i)) for i in range(101)] + [
    (None, "No id, but é 𝔘𝔫𝔦 text\nin two lines"),
    (-5, None),
    (200, ""),
    (201, "word and more " * 20_000),
    (202, "x" * 200_001),
    (203, " \n\t\n "),
    (1 << 40, "The last one.\n"),
]


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_fingerprint_report_equals_a_plain_walk(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.doc_id: r for r in fingerprints.fingerprint_report(doc_table(spark, FINGERPRINTED).repartition(6)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(FINGERPRINTED)
    for own, size, digest, text, changed, after in plain_edits(FINGERPRINTED):
        mine, other, following = Fingerprint.of(text), Fingerprint.of(changed), Fingerprint.of(after)
        assert tuple(got[own]) == (own, size, digest, str(mine), str(other), mine.likeness(other), mine.likeness(following))


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints.fingerprint_report(doc_table(spark, [])).collect() == []
    (one,) = fingerprints.fingerprint_report(doc_table(spark, [(7, "abcd")])).collect()
    assert (one.n_chars, one.edited_sha256, one.near_next) == (4, sha("abab"), 1.0)
    repeats = fingerprints.fingerprint_report(doc_table(spark, [(1, "a b c")] * 5 + [(2, "a b c"), (2, "d e")])).collect()
    assert sorted(r.doc_id for r in repeats) == [1] * 5 + [2, 2] and len({r.fingerprint for r in repeats}) == 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \té𝔘.", max_size=12).filter(bool), max_size=8), st.randoms())
def test_fingerprints_are_sums_of_paragraphs(paragraphs, order):
    whole = Fingerprint.of("\n".join(paragraphs))
    shuffled = list(paragraphs)
    order.shuffle(shuffled)
    assert Fingerprint.of("\n\n".join(shuffled)) == whole
    total = Fingerprint.of("")
    for p in shuffled:
        total = total + Fingerprint.of(p)
    assert total == whole and Fingerprint.parse(str(total)) == whole
    if paragraphs:
        assert whole - Fingerprint.of(paragraphs[0]) == Fingerprint.of("\n".join(paragraphs[1:]))
        assert whole + Fingerprint.of("one more") != whole


def test_likeness_lanes_count_pairs_of_words():
    def number(word):
        return fingerprints.word_hashes(np.frombuffer(word.encode(), dtype=np.uint8))[0]

    for text in ("", " a", "a b", "one two three\nfour\n\n five  six ", words(500, 9), "𝔘 é\x0bb\n", "a" * 10_000 + " b"):
        lanes = np.zeros(fingerprints.LIKE_LANES, dtype=np.int64)
        for paragraph in text.split("\n"):
            row = [number(w) for w in re.findall(r"[^ \t-\r]+", paragraph)]
            units = [fingerprints._mixed(a * np.uint64(fingerprints.FACTOR) + b) for a, b in itertools.pairwise(row)] if len(row) > 1 else row
            for unit in units:
                lanes[int(unit[0]) % fingerprints.LIKE_LANES] += 1 if int(unit[0]) >> 63 else -1
        assert (fingerprints.likeness_lanes(text).view(np.int16) == lanes).all()


def test_likeness_follows_the_shared_part():
    for share in (0.2, 0.5, 0.8):
        found = []
        for seed in range(20):
            common, a, b = words(int(400 * share), seed), words(int(400 * (1 - share)), seed + 100), words(int(400 * (1 - share)), seed + 200)
            found.append(Fingerprint.of(f"{common}\n{a}").likeness(Fingerprint.of(f"{common}\n{b}")))
        assert abs(np.mean(found) - share) < 0.06 and max(abs(f - share) for f in found) < 0.25


def test_near_edited_stands_above_near_next(spark):
    rows = queries.fingerprinted(spark, SMALL).collect()
    long = [r for r in rows if r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.9
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_merged_fingerprints_are_those_of_the_joined_texts(spark):
    rows = [(i, words(i % 9, i)) for i in range(200)]
    prints = fingerprints.fingerprint_texts(doc_table(spark, rows).repartition(7)).selectExpr("_id", "if(_id < 120, 0, _id % 5) as node", "fingerprint")
    got = {r.node: r.fingerprint for r in fingerprints.merge_fingerprints(prints, ["node"]).collect()}
    texts = defaultdict(list)
    for i, t in rows:
        texts[0 if i < 120 else i % 5].append(t)
    assert got == {node: str(Fingerprint.of("\n".join(t))) for node, t in texts.items()}


# Ranked search


def plain_ranks(docs, items, k=20):
    def split(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    counted = [(i, Counter(split(t))) for i, t in docs]
    n = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for own, c in counted:
            if own is None or not c:
                continue
            m = 100 - 25 + (25 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if score > 0:
                scored.append((-score, own))
        out += [(item, rank, own, -s) for rank, (s, own) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


ITEMS = "item_id long, text string, _item int, RANK string"


@pytest.mark.parametrize(("at_once", "block"), [(1, 3), (200_000, 4096), (40, 50)])
def test_ranked_search_equals_a_plain_one(spark, at_once, block):
    random.seed(at_once)
    vocabulary = ["the"] * 20 + ["of"] * 8 + [f"w{i}" for i in range(90)] + ["École", "ÉCOLE", "naïve", "Ab", "aB", "x1-y2"]
    docs = [(i % 150, " ".join(random.choices(vocabulary, k=random.randint(0, 60)))) for i in range(170)]
    docs += [(None, "the w1 w2"), (500, None), (501, "..."), (502, "the " * 300_000 + "w3"), (503, "w1 w2\x00w3"), (504, "w1 w2\x00w3")]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(0, 30)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "W1 w2 W3"), (22, "W1 w2 W3"), (23, "absent word"), (24, " ".join(f"w{i}" for i in range(90)) + " the the the")]
    got = lexical.ranked_search(
        doc_table(spark, docs).repartition(3), spark.createDataFrame([(*i, 1, "r") for i in items], ITEMS), terms_at_once=at_once, block_rows=block
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_ranks(docs, items)


def test_ranked_search_of_empty_tables(spark):
    some = spark.createDataFrame([(1, "the", 1, "r")], ITEMS)
    assert lexical.ranked_search(doc_table(spark, []), some).collect() == []
    assert lexical.ranked_search(doc_table(spark, [(1, "the")]), some.limit(0)).collect() == []
    assert lexical.ranked_search(doc_table(spark, [(1, "...")]), some).collect() == []


def test_masks_spare_most_documents():
    """An item is finished long before every document that shares a term with it was evaluated."""
    rng = np.random.default_rng(1)
    held = [sorted(set(np.minimum(rng.zipf(1.3, 30), 400).tolist())) for _ in range(3000)]
    starts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    terms = np.array([t for h in held for t in h])
    values = rng.integers(100_000, 900_000, len(terms))
    block = lexical.Block(np.arange(3000), starts, terms, values, 401)
    weights = np.zeros(401, dtype=np.int64)
    asked = np.array([1, 2, 3, 40, 90, 150, 233])
    weights[asked] = [10, 20, 50, 4000, 5000, 6000, 7000]
    best, seen = block.search(asked, weights, [], 5)
    plain = sorted((-int((weights[terms[starts[d] : starts[d + 1]]] * values[starts[d] : starts[d + 1]]).sum()), d) for d in range(3000))
    assert best == plain[:5] and seen < 1000
