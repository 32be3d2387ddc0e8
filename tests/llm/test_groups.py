"""Spelling variants, SimHash groups and the conversation trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from shopmarts.llm import prefix_trie, queries, simhash, spelling
from shopmarts.session import tune
from tests.llm.conftest import ODD

FOLDER = "/root/testdata/sf0.001"


# Spelling variants


def words_of(rows):
    found = Counter()
    for name, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def variants_of(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


FIELDS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants_are_those_of_brute_force(spark):
    rng = random.Random(11)
    words = {}
    for _ in range(60):
        word = "".join(rng.choice("abÿ") for _ in range(rng.choice([7, 7, 8, 9, 12])))
        words[word] = rng.choice([2, 3, 20, 30, 300, 4000])
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(word))
            word = word[:at] + rng.choice(["", "a", "ÿ", "ab"]) + word[at + rng.randint(0, 1) :]
            if len(word) >= 7:
                words[word] = rng.choice([2, 3, 20, 30, 300, 4000])
    for size in (64, 65, 66, 300, 301, 20_000):  # a repeated letter may be inserted anywhere
        words["e" * size] = size
        words["e" * (size - 1) + "f"] = size * 11
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = spelling.variants(frame).select(*FIELDS).collect()
    assert len(found) == len(words)
    assert {tuple(r) for r in found} == variants_of(words)
    assert any(r.form and r.form != r.root for r in found)


def test_words_of_odd_texts(spark, documents):
    texts = [*ODD, "ÀÉÎÕÜ×÷ÀB " * 3, "ABCDEFGabcdefg", "StraßenbahnĀStraßenbahn", "x1y" * 9, "Whatever whatever WHATEVER " * 40]
    rows = [(i if i % 4 else None, t) for i, t in enumerate(texts)] * 2
    found = spelling.counted_words(documents(*rows)).collect()
    assert {r.word: r.n for r in found} == words_of(rows)
    assert spelling.variants(spelling.counted_words(documents().where("false"))).collect() == []


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "éa straßenbahn, ÿ" * 50
    monkeypatch.setattr(spelling, "SLICE", 13)
    pieces = list(spelling._slices(text.encode()))
    assert "".join(pieces) == text and len(pieces) > 40
    assert Counter(w for p in pieces for w in re.findall("[a-zÀ-ÿ]+", p)) == Counter(re.findall("[a-zÀ-ÿ]+", text))


def test_a_tile_may_span_batches_and_blocks(monkeypatch):
    monkeypatch.setattr(spelling, "CELLS", 50)
    words = [f"{a}{b}ccccc" for a in "abcdefgh" for b in "abcdefgh"]
    rows = {
        "longer": pa.array([7] * 64, pa.int32()),
        "place": pa.array([0] * 64, pa.int32()),
        "width": pa.array([2] * 64, pa.int32()),
        "tile": pa.array([5] * 64, pa.int64()),
        "word": words,
        "n": pa.array(range(64), pa.int64()),
    }
    batches = pa.table(rows).to_batches(max_chunksize=9)
    found = pa.Table.from_batches(list(spelling._paired(iter(batches)))).to_pylist()
    assert {r["word"]: r["n_near"] for r in found} == {w: 14 for w in words}
    assert all(r["near"] == max((v for v in words if one_edit(v, r["word"])), key=words.index) for r in found)


# SimHash


def print_of(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(names, prints, radius=3):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for name, x in zip(names, label):
        if name is not None:
            least[x] = min(name, least.get(x, name))
    return [least.get(x) for x in label]


def test_groups_of_texts(spark, documents):
    rng = random.Random(4)
    texts = [*ODD, "one", "One two", "one  two three", "ONE TWO three", "\x1cone two three"]
    base = [rng.choice("abcdefghij") * 3 for _ in range(200)]
    for _ in range(20):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "zz"
        texts.append(" ".join(words))
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (rows[7][0], "another text of some words")]
    found = simhash.near_duplicates(documents(*rows).repartition(3)).collect()
    prints = [print_of(t) for _, t in rows]
    wanted = groups_of([i for i, _ in rows], prints)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(
        ((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, wanted)), key=key
    )
    assert simhash.near_duplicates(documents().where("false")).collect() == []


def test_long_texts_in_slices(monkeypatch):
    text = "Ein Wort folgt\x0bdem  andern\nund wieder " * 30
    whole = simhash.fingerprint(text.encode())
    assert whole == print_of(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text.encode()) == whole


@pytest.mark.parametrize("pieces", simhash.LEVELS)
def test_near_prints_share_a_shard(pieces):
    rng = random.Random(pieces)
    masks = simhash.masks(pieces, 3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), 3))
        assert any((a ^ b) & mask == 0 for mask in masks)
    assert all((mask % (1 << 64)).bit_count() >= 64 - 3 * -(-64 // pieces) for mask in masks)


def test_trees_find_what_is_near():
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    noise = np.uint64(1) << rng.integers(0, 64, (3, 900), dtype=np.uint64)
    values = np.repeat(centre, 150) ^ noise[0] ^ noise[1] ^ noise[2]
    shard = np.sort(rng.integers(0, 9, 900))
    order = np.unique(np.stack([shard.astype(np.uint64), values]), axis=1)
    shard, values = order[0].astype(np.int64), order[1]
    forest = simhash.BKForest(values, shard)
    a, b = forest.near(np.arange(len(values)), 3)
    wanted = {
        (i, j)
        for i in range(len(values))
        for j in range(len(values))
        if i != j and shard[i] == shard[j] and int(values[i] ^ values[j]).bit_count() <= 3
    }
    assert set(zip(a.tolist(), b.tolist())) == wanted and len(a) == len(wanted)


def test_full_shards_are_dealt_again(spark, monkeypatch):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    prints = [centre ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 6))) for _ in range(400)]
    prints = sorted(set(prints)) + [rng.getrandbits(64) for _ in range(50)]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "print long")

    def components_of():
        links = simhash.near_links(frame).collect()
        label = {p[0]: p[0] for p in signed}
        for link in links:
            old, new = label[link.a], label[link.b]
            label = {p: new if x == old else x for p, x in label.items()}
        groups = {}
        for p, x in label.items():
            groups.setdefault(x, set()).add(p % (1 << 64))
        return sorted(map(sorted, groups.values()))

    wanted = {}
    for p, c in zip(prints, groups_of(prints, prints)):
        wanted.setdefault(c, set()).add(p)
    wanted = sorted(map(sorted, wanted.values()))
    assert components_of() == wanted and 1 < len(wanted) < len(prints)
    for shard in (20, 2):
        monkeypatch.setattr(simhash, "SHARD", shard)
        assert components_of() == wanted


def test_op12_gives_the_groups_of_brute_force(spark):
    given = queries.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    prints = [print_of(r.text) for r in given]
    wanted = groups_of([r.doc_id for r in given], prints)
    found = queries.QUERIES["op12_simhash_bktree"](tune(spark), FOLDER)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect())) == sorted(
        (r.doc_id, f"{p:016x}", c) for r, p, c in zip(given, prints, wanted)
    )
    assert len(set(wanted)) < len(given)


# Conversations


def trie_of(sequences):
    nodes = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    below = {}
    for p in nodes:
        if p:
            below.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        leaves[p] = sum(leaves[q] for q in below.get(p, [])) or 1
        saved[p] = own + sum(saved[q] for q in below.get(p, []))
    found = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if sequences[c] == p))
        above = min(nodes[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(members), len(p), above, len(members), len(below.get(p, [])), leaves[p], saved[p], digest))
    return Counter(found)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: tuple(t[1:] for t in sorted(turns, key=lambda t: t[:2])) for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        found[c] = own.get(c - c % 5, ())[:h] + turns[h:]
    return found


def random_rows(rng, conversations):
    rows = []
    for c in rng.sample(range(5000), conversations):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 12])):
            rows.append((c, turn or None, rng.choice(["user", "user", None, "tool"]), rng.choice(["a", "é", "", None])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, depth string, own string"


def test_trie_is_that_of_brute_force(spark):
    rng = random.Random(13)
    rows = random_rows(rng, 150) + [(None, 1, "user", "lost"), (7000, None, None, None)]
    rows += [(c, t, "user", "same") for c in range(8000, 8300) for t in range(3)]
    rows += [(9000, t, "user", "long") for t in range(900)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("1", "37"):  # in 37, paths cross partitions and joins take two rounds
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found = prefix_trie.prefix_trie(prefix_trie.branched(prefix_trie.turn_sequences(frame))).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert Counter(map(tuple, found)) == trie_of(rebuilt(rows))


def test_no_conversations_have_no_nodes(spark):
    frame = spark.createDataFrame([(None, 1, "user", "a", "", "")], SCHEMA)
    for rows in (frame, frame.where("false")):
        assert prefix_trie.prefix_trie(prefix_trie.branched(prefix_trie.turn_sequences(rows))).collect() == []


def test_turns_with_equal_numbers_have_a_fixed_order(spark):
    rows = [(1, 4, "b", "x", "", ""), (1, 4, "a", "y", "", ""), (1, None, "c", "z", "", ""), (1, 4, "a", "y", "", "")]
    one = prefix_trie.turn_sequences(spark.createDataFrame(rows, SCHEMA)).first().turns
    two = prefix_trie.turn_sequences(spark.createDataFrame(rows[::-1], SCHEMA)).first().turns
    assert one == two and len(one) == 4 and one[1] == one[2]


@pytest.mark.parametrize("seed", range(30))
def test_segments_join_in_any_grouping(seed):
    """Blocks of any size, joined in any order of neighbours, give the same complete nodes."""
    rng = random.Random(seed)

    def turn(text):
        return hashlib.md5(text.encode()).digest() + len(text).to_bytes(8, "big")

    letters = {turn(t): ("", t) for t in ("a", "bb", "ccc")}
    sequences = {
        c: tuple(rng.choice(list(letters)) for _ in range(rng.choice([0, 1, 2, 3, 6])))
        for c in range(rng.choice([1, 2, 9, 60]))
    }
    ends = {}
    for c, turns in sequences.items():
        ends.setdefault(b"".join(turns), []).append(c)
    items = [
        (s, min(ids), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        for s, ids in sorted(ends.items())
    ]
    rows, segments = [], []
    while items:
        size = rng.randint(1, 9)
        segment, more = prefix_trie.block_segment(items[:size])
        items = items[size:]
        segments.append(segment)
        rows += more
    while len(segments) > 1:
        at = rng.randrange(len(segments) - 1)
        joined, more = prefix_trie.join_segments(*segments[at : at + 2])
        segments[at : at + 2] = [joined]
        rows += more
    rows += prefix_trie.finished(segments[0])
    conv = {own: smallest for smallest, *_, own, _ in rows if own is not None}
    found = Counter((r[0], r[1], conv[r[9]] if r[9] is not None else r[2], *r[3:8]) for r in rows)
    assert found == trie_of({c: tuple(letters[t] for t in turns) for c, turns in sequences.items()})
