"""Chat formatting, the conversation trie and collocations against brute force, and their results for odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import chat, collocations, conversation_trie
from clickloom.llm.radix_tree import Direct, Indexed, Sorted, Tree

TURNS = "conv_id long, turn long, role string, text string"
LONG = "very " * 60_000
#: Ties, repeated rows, nulls in every column, empty and long texts, texts and roles that hold marks and escapes.
ODD = [(1, 0, "user", "a<|b"), (1, 1, "user", "x<\\|y<"), (1, 2, "assistant", "é😀<|im_sep|>"), (1, 3, "assistant", ""), (1, None, None, None),
       (2, 0, "as\nsis<|im_end|>%+ ", None), (None, 1, "assistant", "q"), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "a"),
       (4, 0, "user", LONG), (4, 1, "assistant", LONG), (-7, 2, "assistant", "<|im_end|>\n<|im_start|>user\n"), (20, 0, "user", "a<|b"), (21, 0, "user", "a<|b"),
       (22, 0, "user", "other"), (23, 0, "", ""), (40, 0, "user", "<<|"), (41, 0, "user", "<<<\\\\|"), (41, 1, "assistant", "|<\\")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_turn(rows, tie):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    return {conv: [t[3:] for t in sorted(turns)] for conv, turns in found.items()}


def test_turns_and_learned_text_come_back_from_the_formatted_text(odd):
    clashing = odd.selectExpr("*", "1 as t", "'x' as loss", "array(1) as parts", "2 as heads", "3 as n_blocks")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(clashing)).collect()}
    want = by_turn(ODD, lambda role, text: (role, text))
    assert set(got) == set(want)
    for conv, turns in want.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), sha(learned))


def test_adjacent_turns_of_a_role_share_a_block_and_texts_hold_no_mark(spark, odd):
    got = {r["conv_id"]: r for r in chat.formatted(odd).collect()}
    assert got[3]["formatted"] == "<|im_start|>assistant\na<|im_sep|>a<|im_sep|>b<|im_end|>\n" and got[3]["n_blocks"] == 1
    assert [(s["start"], s["bytes"]) for s in got[3]["loss"]] == [(22, 1), (33, 1), (44, 1)]
    assert got[1]["n_blocks"] == 3 and got[1]["formatted"].count("<|im_sep|>") == 2
    forged = chat.formatted(chat.probe(spark)).first()
    assert forged["formatted"].count("<|im_end|>") == 2 and forged["n_blocks"] == 2
    assert chat.formatted(odd.limit(0)).count() == 0


def test_a_conversation_of_many_turns_has_right_spans(spark):
    n = 5000
    rows = spark.range(n).selectExpr("9 as conv_id", "id as turn", "if(id % 3 = 0, 'user', 'assistant') as role", "concat('é', id) as text")
    got = chat.digests(chat.formatted(rows)).first()
    learned = "".join(f"é{i}" for i in range(n) if i % 3)
    assert (got["n_turns"], got["loss_sha256"]) == (n, sha(learned))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(max_size=6) | st.binary(max_size=2).map(lambda b: b * 3), min_size=1, max_size=120))
def test_the_tree_holds_what_was_put_in(keys):
    tree = Tree()
    for key in keys:
        tree.insert(key, (key,))
    for key in keys:
        way = tree.path(key)
        assert way[-1].value == (key,)
    found, todo = set(), [(tree.root, b"")]
    while todo:
        node, before = todo.pop()
        here = before + node.path
        if node.value is not None:
            assert node.value == (here,)
            found.add(here)
        assert node.value is not None or len(node.children()) > 1  # paths are compressed
        todo.extend((kid, here + bytes([b])) for b in range(256) if (kid := node.get(b)) is not None)
    assert found == keys


def test_layouts_grow_with_their_children():
    tree = Tree()
    kinds = []
    for byte in range(256):
        tree.insert(bytes([byte, 7]), byte + 1)
        kinds.append((type(tree.root.places), getattr(tree.root.places, "room", None)))
    assert kinds[0] == (type(None), None) and kinds[3] == (Sorted, 4) and kinds[4] == (Sorted, 16) and kinds[15] == (Sorted, 16)
    assert kinds[16] == kinds[47] == (Indexed, None) and kinds[48] == kinds[255] == (Direct, None)
    assert [tree.path(bytes([b, 7]))[-1].value for b in range(256)] == list(range(1, 257))


def brute_trie(rows):
    own = by_turn([r for r in rows if r[0] is not None], lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
    full = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(np.fmod(conv, 20))
        full[conv] = tuple(own.get(base, [])[:h] + turns[h:])
    members, kids, leaves, saved = defaultdict(list), defaultdict(list), {}, {}
    for conv, key in full.items():
        for depth in range(len(key) + 1):
            members[key[:depth]].append(conv)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    for key in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + (len(members[key]) - 1) * words
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -99, len(m), len(kids[k]), leaves[k], saved[k],
                   sha(",".join(map(str, sorted(c for c in m if full[c] == k))))) for k, m in members.items())


def found_trie(turns, **options):
    got = conversation_trie.trie(conversation_trie.with_shared_heads(conversation_trie.turn_lists(turns)), **options)
    return sorted((r["conv_id"], r["depth"], -99 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in got.collect())


@pytest.mark.parametrize("options", [{}, {"run_keys": 1, "piece": 1}, {"run_keys": 3, "piece": 2}])
def test_nodes_equal_brute_force_however_the_keys_are_cut(spark, odd, options):
    many = [(c, t, "user", f"{'ab'[c * t % 2]} w{c % 3 * (t > 1)}") for c in range(60) for t in range(c % 7)]
    rows = [r for r in ODD if r[0] is None or r[0] in (1, 2, 3, -7)] + many + [(100 + c, t, "user", str(t)) for c in range(3) for t in range(40 + c)]
    assert found_trie(spark.createDataFrame(rows, TURNS), **options) == brute_trie(rows)


def test_odd_conversations_and_no_conversations(spark, odd):
    clashing = odd.selectExpr("*", "'x' as key", "1 as t", "2 as digest", "3 as _base", "4 as words", "5 as node")
    assert found_trie(clashing) == brute_trie(ODD)
    assert found_trie(odd.limit(0)) == []
    assert found_trie(spark.createDataFrame([(21, 0, "user", "w")], TURNS)) == brute_trie([(21, 0, "user", "w")])


def brute_phrases(rows, threshold, most=2000):
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    can = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= threshold}
    gone = {(lang, w[i:i + m]) for (lang, w), a in can.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if 100 * a >= 80 * f[lang, w[i:i + m]]}
    found = defaultdict(list)
    for (lang, w), a in can.items():
        if (lang, w) not in gone:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang in sorted(found) for i, (s, a, p, left, right) in enumerate(sorted(found[lang])[:most])]


@pytest.mark.parametrize("capacity", [collocations.CAPACITY, 20])
def test_phrases_equal_brute_force(spark, capacity):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_phrases([tuple(r) for r in docs.select("lang", "text").collect()], 30)
    got = collocations.phrases(docs, capacity=capacity).orderBy("lang", "rank").collect()
    assert want and [tuple(r) for r in got] == want


def test_phrases_of_odd_rows(spark):
    rows = [(None, "A b c. a B c,a b"), ("und", "a b\tc  a\nb"), ("en", None), (None, ""), (None, "a b é 😀 é 😀 a"), ("x", "...,,, \t"),
            ("long", "one two three; " * 120_000), ("long", "nobreak " * 200_000)] * 2
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as h", "'x' as phrase", "2 as n", "3 as _lang", "4 as words")
    for capacity in (collocations.CAPACITY, 1):
        got = collocations.phrases(docs, threshold=2, capacity=capacity).orderBy("lang", "rank").collect()
        assert [tuple(r) for r in got] == brute_phrases(rows, 2)
    assert collocations.phrases(docs.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=60), min_size=1, max_size=6), st.integers(1, 8))
def test_merged_summaries_keep_every_frequent_key(parts, capacity):
    threshold, true = 30, Counter()
    whole = collocations.Summary(threshold, capacity)
    for part in parts:
        for key, count in part:
            true[key] += count
            whole.add(np.array([key], np.uint64), np.array([count]))
    other = collocations.Summary(threshold, capacity)
    other.add(np.array([3], np.uint64), np.array([4]))
    true[3] += 4
    whole.merge(other)
    assert {k for k, c in true.items() if c >= threshold} <= set(whole.survivors().tolist())
    assert whole.lost < threshold
    if capacity > sum(true.values()) // threshold:
        assert whole.capacity == capacity  # no growth where the capacity exceeds mass over threshold
