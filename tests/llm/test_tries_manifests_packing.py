"""Operators 11 to 13 against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from scrutin.llm import merkle, packing, prefix_trie, radix

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- radix tree

def test_radix_tree_holds_every_key_and_grows_its_layouts():
    rng = random.Random(3)
    keys = [bytes(rng.choice([0, 1, 255, rng.randrange(256)]) for _ in range(rng.choice([0, 1, 2, 3, 20]))) for _ in range(3000)]
    tree, held = radix.Tree(), {}
    for i, k in enumerate(keys):
        tree.insert(k, i)
        held.setdefault(k, []).append(i)
    kinds = set()
    todo, found = [(tree.root, b"")], {}
    while todo:
        node, at = todo.pop()
        at += node.prefix
        if node.payloads:
            found[at] = node.payloads
        # path compression: a node without payload branches, but for the root
        assert node.payloads or len(list(node.items())) > 1 or node is tree.root
        kinds.add((type(node.below).__name__, getattr(node.below, "limit", 0)))
        todo += [(c, at + bytes([b])) for b, c in node.items()]
    assert found == held
    assert kinds >= {("Small", 4), ("Small", 16), ("Indexed", 0), ("Direct", 0)}
    for k in held:
        assert tree.path(k)[-1].payloads == held[k]


def test_agreement():
    assert [radix.agreement(a, b) for a, b in ((b"", b"a"), (b"ab", b"ab"), (b"ab", b"abc"), (b"\0a", b"\0b"), (b"x", b"y"))] == [0, 2, 2, 1, 0]


# ---------------------------------------------------------------- operator 11

def brute_trie(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append(((t is not None, t or 0, sha(f"{len(r.encode())}:{r}:{x}")[:32]), (r, x)))
    own = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    nodes, kids = {}, {}
    for c, q in seqs.items():
        for d in range(len(q) + 1):
            nodes.setdefault(q[:d], []).append(c)
    for q in nodes:
        kids.setdefault(q[:-1], []).append(q) if q else None
    leaves, saved = {}, {}
    for q in sorted(nodes, key=len, reverse=True):
        below = kids.get(q, [])
        leaves[q] = sum(leaves[k] for k in below) or 1
        saved[q] = (len(nodes[q]) - 1) * (len(q[-1][1].encode()) if q else 0) + sum(saved[k] for k in below)
    return sorted(((min(m), len(q), min(nodes[q[:-1]]) if q else None, len(m), len(kids.get(q, [])), leaves[q], saved[q],
                    sha(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(q)))) for q, m in nodes.items()), key=str)


def conversations(seed):
    """Copies, shared beginnings, prefixes of one another, very long ones, null and equal turns."""
    rng = random.Random(seed)
    rows = [(None, 1, "user", "nobody's")]
    for c in range(400):
        n = rng.choice([1, 2, 3, 5, 12, 60])
        for t in range(n):
            text = f"same {t}" if t < rng.choice([2, 9, 40]) else rng.choice(["a", "b", None, "Ünï"])
            rows.append((c * rng.choice([1, 1, 5]), None if rng.random() < 0.02 else t, rng.choice(["user", "user", None]), text))
    return rows


@pytest.mark.parametrize("seed, part_bytes, ends", [(0, 1 << 24, 1024), (1, 2000, 1), (2, 300, 3)])
def test_trie(spark, monkeypatch, seed, part_bytes, ends):
    monkeypatch.setattr(prefix_trie, "PART_BYTES", part_bytes)
    monkeypatch.setattr(prefix_trie, "ENDS", ends)
    rows = conversations(seed)
    got = prefix_trie.shared_prefixes(spark.createDataFrame([(*r, 0) for r in rows], TURNS + ", part long"))
    assert rows_of(got) == brute_trie(rows)


def test_trie_of_one_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_BYTES", 500)
    rows = [(i, t, "user", f"copy {t}") for i in range(0, 1500, 5) for t in range(10)] + [(1501, t, "user", f"copy {t}") for t in range(9)]
    assert rows_of(prefix_trie.shared_prefixes(spark.createDataFrame(rows, TURNS).repartition(5))) == brute_trie(rows)


def test_trie_edges(spark):
    assert prefix_trie.shared_prefixes(spark.createDataFrame([], TURNS)).count() == 0
    # conversations that are empty once rebuilt end at the root
    rows = [(6 + 5 * i, 0, "r", "t") for i in range(20)]
    got = prefix_trie.shared_prefixes(spark.createDataFrame(rows, TURNS))
    assert rows_of(got) == brute_trie(rows) and any(r.depth == 0 and r.ends_sha256 != prefix_trie.EMPTY_SHA for r in got.collect())
    long = [(1, 8, "user", "x" * 3_000_000), (1, 9, None, None)]
    assert rows_of(prefix_trie.shared_prefixes(spark.createDataFrame(long, TURNS))) == brute_trie(long)


def test_trie_turns(spark):
    df = spark.createDataFrame([(0, 0, "user", "hello"), (0, 1, None, None), (3, 0, "user", "hello")], TURNS)
    nodes = prefix_trie.prefix_trie(prefix_trie.sequences(df))
    got = {(r.depth, r.role, r.text, r.n_convs) for r in prefix_trie.with_turns(nodes, df).collect()}
    assert got == {(0, None, None, 2), (1, "user", "hello", 2), (2, "", "", 1)}


# ---------------------------------------------------------------- operator 12

def brute_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([sha(*below[i:i + 3]) for i in range(0, len(below), 3)])
        return levels

    def runs(levels, i):
        for level in levels[:-1]:
            yield level[i - i % 3:i - i % 3 + 3], i % 3
            i //= 3

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*map(field, r)), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, siblings = sha(*map(field, (*r[:4], text))), []
            for run, j in [*runs(trees[s], i), *runs(top, k)]:
                siblings += run[:j] + run[j + 1:]
                folded = sha(*run[:j], folded, *run[j + 1:])
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], sha(*siblings), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def documents(n, sources, seed=0):
    rng = random.Random(seed)
    rows = [(rng.randrange(n), rng.choice([f"s{rng.randrange(sources)}", "hot"]), rng.choice(["en", None]), 3, rng.choice(["a\nb", "Ä", "", None, "x" * 999])) for _ in range(n)]
    return rows + [(None, None, None, None, None), (None, None, None, None, None), (7, "", "", 0, "\n"), (7, "", "", 0, "\n")]


@pytest.mark.parametrize("n, sources, bound", [(400, 6, 4_000), (900, 4, 4), (8000, 2, 4), (600, 400, 4)])
def test_manifest(spark, monkeypatch, n, sources, bound):
    """Broadcast only; shuffled low levels; a large top tree, in copies."""
    monkeypatch.setattr(merkle, "BROADCAST_LINKS", bound)
    monkeypatch.setattr(merkle, "SALTS", 3)
    rows = documents(n, sources)
    limit = spark.conf.get(merkle._ROW_LIMIT)
    got = merkle.verifications(spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", pos long, tree string").repartition(4))
    assert rows_of(got) == brute_manifest(rows)
    assert spark.conf.get(merkle._ROW_LIMIT) == limit


@pytest.mark.parametrize("n", [0, 1, 3, 4, 10, 28, 82, 244])
def test_manifest_of_one_source(spark, n):
    rows = [(i, "s", "en", i, "a\nb") for i in range(n)]
    assert rows_of(merkle.verifications(spark.createDataFrame(rows, DOCS))) == (brute_manifest(rows) if rows else [])


def test_phases_follow_the_climb():
    levels = [(False, 1, 90_000), (False, 2, 1_100), (False, 3, 14), (True, 1, 30_000), (True, 2, 370)]
    assert merkle._phases(levels) == [(False, [(False, 1)]), (True, [(False, 2), (False, 3)]), (False, [(True, 1)]), (True, [(True, 2)])]


# ---------------------------------------------------------------- operator 13

TEXTS = ["", None, "a", "hello, world's\n\n  end", "<|endoftext|> 1234 Ünï 語 " * 30, " " * 5000, "x" * 100_000, "word " * 5000, "word " * 5000]


def test_packing(spark):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(packing.default_tokenizer())
    own.encode_special_tokens = True
    data = [(i, t, "id", 0) for i, t in enumerate(TEXTS)] + [(None, "null id", "id", 0)]
    got = packing.packed(spark.createDataFrame(data, "doc_id long, text string, ids string, length long").repartition(3)).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by = {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.length.bit_count() == 1 and r.length <= packing.LONGEST and r.offset == 0 and len(r.ids) == 4 * r.length
        by.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in data:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        assert b"".join(r.ids for r in by[i]) == np.array(ids, "<u4").tobytes()
        assert [r.length for r in by[i]] == packing.lengths(len(ids)) and {r.doc_tokens for r in by[i]} == {len(ids)}
        assert [r.start for r in by[i]] == [sum(packing.lengths(len(ids))[:k]) for k in range(len(by[i]))]
    # one length after the other
    assert [r.length for r in sorted(got, key=lambda r: r.sequence_id)] == sorted(r.length for r in got)


def test_packing_does_not_depend_on_the_layout(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    one, many = (rows_of(packing.packed_digest(d)) for d in (df.coalesce(1), df.repartition(6)))
    assert one == many and all(r[3] == zlib.crc32(x.ids) for r, x in zip(one, sorted(packing.packed(df).collect(), key=lambda x: str((x.doc_id, x.start, x.length, zlib.crc32(x.ids))))))
    assert packing.packed(df.limit(0)).count() == 0


def test_lengths():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        cut = packing.lengths(n)
        assert sum(cut) == n and cut == sorted(cut, reverse=True) and len(set(cut)) + n // 2048 - (n >= 2048) == len(cut)
    with pytest.raises(ValueError):
        packing.pieces(None, longest=100)


def test_other_vocabularies_use_their_own_library(spark):
    assert packing.byte_pair_ranks({"model": {"type": "BPE"}, "normalizer": {"type": "Lowercase"}}) is None
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    ids = Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids
    got = packing.packed(spark.createDataFrame([(1, "Hello there")], "doc_id long, text string"), tokenizer=path).collect()
    assert b"".join(r.ids for r in sorted(got, key=lambda r: r.start)) == np.array([*ids, 1], "<u4").tobytes()
