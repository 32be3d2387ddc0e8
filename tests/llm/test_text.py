"""Words in blocks, tokens by pieces, and the shard and archive formats."""

import gc
import hashlib
import random
import re
import struct
import tracemalloc
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard

from shopmarts.llm import repair, warc
from shopmarts.llm.tokenizing import Encoder
from shopmarts.llm.words import ALPHANUMERIC, NOT_SPACE, blocks, find_words, shingle_hashes
from tests.llm.conftest import ODD

PATTERNS = [
    (ALPHANUMERIC, re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")),
    (NOT_SPACE, re.compile(r"[^\x20\x09-\x0D]+")),
]


def texts(count, seed=0):
    rng = random.Random(seed)
    alphabet = "aB9 \n\t.-é中\x0b'İ"
    return [None, ""] + ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize("table,pattern", PATTERNS)
def test_words_are_those_of_the_pattern(table, pattern):
    given = texts(300)
    found = find_words(pa.array(given)[1:], table)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    wanted = [pattern.findall((t or "").translate(lower)) for t in given[1:]]
    assert found.counts.tolist() == [len(w) for w in wanted]
    flat = [w for own in wanted for w in own]
    assert [found.slice_text(i, i + 1).decode() for i in range(len(flat))] == flat
    by_hash = dict(zip(found.hash.tolist(), flat, strict=True))
    assert len(by_hash) == len(set(flat))


def test_shingles_tell_order_and_length_apart():
    words = np.array([1, 2, 3, 2, 1], np.uint64)
    two = shingle_hashes(words, 2)
    assert len(set(two.tolist())) == 4 and len(shingle_hashes(words, 6)) == 0
    assert not set(two.tolist()) & set(shingle_hashes(words, 1).tolist())


def test_blocks_cover_all_rows():
    given = pa.array(["ab", None, "c" * 100, "", "d"])
    parts = list(blocks(given, 50))
    assert [x for _, part in parts for x in part.to_pylist()] == given.to_pylist()
    assert len(parts) > 1 and list(blocks(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys(name):
    coder = Encoder(public_tokenizers.path(name), kept=500)
    rng = random.Random(2)
    alphabet = ["the", "The", " ", " ", "\n", "  ", "é", "é", "İ", "'s", "'", "12", ".", "!!", "_", "²", "ﬁ"]
    alphabet += ["<|endoftext|>", "中文", "\x00", "\x01", "\x1c", " ", "naïve", "́", "Å", "ǅ"]
    given = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(1500)]
    given += [x for x in ODD if x]
    for at in range(0, len(given), 50):
        part = given[at : at + 50]
        for text, found in zip(part, coder.encode(part), strict=True):
            wanted = coder.library.encode(text, add_special_tokens=False).ids
            assert array("I", wanted).tobytes() == found, text
    assert coder.encode([None, ""]) == [b"", b""] and len(coder.known) <= 2_000


def test_a_grammar_gives_every_document_back():
    rng = np.random.default_rng(0)
    for case in range(60):
        parts = [
            np.append(rng.integers(3, 4 + case % 9, rng.integers(0, 400)), 2).astype("<u4").tobytes()
            for _ in range(1 + case % 5)
        ]
        content = repair.shard(list(range(len(parts))), parts)
        found = repair.Shard(memoryview(content))
        assert found.ids().tobytes() == b"".join(parts) and found.size == len(content)
        for i, part in enumerate(parts):
            assert found.document(i).tobytes() == part
        rules = found.grammar
        for r, (a, b) in enumerate(zip(rules.left, rules.right, strict=True)):
            widths = [1 if x < rules.base else rules.length[x - rules.base] for x in (a, b)]
            assert rules.length[r] == sum(widths)


def test_repeats_are_compressed():
    one = np.tile(np.arange(10, 20, dtype="<u4"), 500)
    content = repair.shard([1], [np.append(one, 2).astype("<u4").tobytes()])
    assert len(content) < len(one)  # of 4 bytes each
    assert len(repair.Shard(memoryview(content)).grammar.left) > 3


def test_a_changed_shard_is_refused():
    content = bytearray(repair.shard([1], [b"\5\0\0\0\2\0\0\0"]))
    with pytest.raises(repair.BadShard):
        repair.Shard(memoryview(bytes(content[:-1])))
    content[-1] ^= 1
    with pytest.raises(repair.BadShard):
        list(repair.shards_of(bytes(content)))


def written(tmp_path, name):
    return f"file://{tmp_path}/{name}"


def test_shards_round_trip(spark, documents, tmp_path):
    given = [(i * 7 % 50 - 3, t) for i, t in enumerate([*ODD, "b a", *texts(40)])]
    given += [given[0], (None, "no id"), (5, "again")]
    folder = written(tmp_path, "ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = repair.write_shards(
        documents(*given).repartition(3), folder, path, shard_tokens=50, shards_per_file=2
    )
    found = repair.stored_documents(spark, folder, manifest).orderBy("start").collect()
    coder = Encoder(path)
    least = -(1 << 63)
    ordered = sorted(given, key=lambda x: (least if x[0] is None else x[0], x[1] is not None, x[1] or ""))
    at = 0
    for row, (name, text) in zip(found, ordered, strict=True):
        ids = coder.encode([text])[0] + b"\2\0\0\0"
        assert (row.doc_id, row.start, row.n_tokens) == (least if name is None else name, at, len(ids) // 4)
        assert row.ids_crc32 == zlib.crc32(ids)
        at += len(ids) // 4
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at


def test_no_documents_make_no_shard(spark, documents, tmp_path):
    folder = written(tmp_path, "none")
    empty = documents("a").limit(0)
    manifest = repair.write_shards(empty, folder, public_tokenizers.path("word_bpe_49k.json"))
    assert manifest.count() == 0 and repair.stored_documents(spark, folder, manifest).count() == 0


PAGES = "page_id long, url string, html string, digest string, refers_to string"


def pages(spark, *rows):
    return spark.createDataFrame([(*row, "d", "r") for row in rows], PAGES)


def test_archives_round_trip(spark, documents, tmp_path):
    documents("a")
    long, other = "<p>é" * 400, "<p>x" * 400
    rows = [
        (1, "http://a/\r\nX: 1 %", long),
        (2, None, long),
        (9, "http://b", long),
        (9, "http://b", long),
        (3, "http://c", "short"),
        (4, "http://d", "short"),
        (5, "http://e", None),
        (6, "http://f", ""),
        (7, "http://g", other),
        (None, "http://h", other),
        (8, "http://i", "z" * 3_000_000),
    ]
    folder = written(tmp_path, "warc")
    manifest = warc.write_archives(pages(spark, *rows).repartition(3), folder, file_bytes=200)
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)
    found = warc.read_archives(spark, folder, payloads=True).collect()
    by_row = {(r.page_id, r.url): r for r in found}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        row = by_row[page_id, url]
        payload = (html or "").encode()
        again = html == long and page_id != 9
        assert row.payload_bytes == len(payload)
        assert row.payload_digest == __import__("hashlib").sha1(payload).hexdigest()
        assert (row.record_type, row.refers_to) == (("revisit", 9) if again else ("response", None))
        assert row.payload == (None if again else payload)


def test_no_pages_make_no_archive(spark, documents, tmp_path):
    documents("a")
    folder = written(tmp_path, "none")
    assert warc.write_archives(pages(spark, (1, "u", "h")).limit(0), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_wrong_archives_are_refused():
    import struct

    import zstandard

    digest = __import__("hashlib").sha1(b"body").hexdigest()
    record = warc.record_bytes(warc.Record(1, "u", "response", None, 4, digest, b"body"))
    begin = struct.pack("<II", warc.SKIPPABLE, 0)
    frame = zstandard.ZstdCompressor().compress(record)
    assert [r.payload for r in warc.archive_records(begin + frame + frame)] == [b"body"] * 2
    for wrong in (frame, begin + frame[:-3], begin + frame + b"junk", b"", begin + b"\0\0\0\0"):
        with pytest.raises(warc.BadArchive):
            list(warc.archive_records(wrong))
    for old, new in (
        (b"body", b"bodY"),
        (b"WARC/1.1", b"WARC/9.9"),
        (b"Content-Length: 4", b"Content-Length: 5"),
        (b"WARC-Type: response", b"WARC-Type: metadata"),
        (b"<urn:page:1>", b"<urn:else:1>"),
        (b"WARC-Record-ID", b"WARC-Record-IX"),
    ):
        with pytest.raises(warc.BadArchive):
            warc.parse_record(record.replace(old, new))


def test_a_shared_dictionary_is_read_from_the_archive(spark, documents, tmp_path):
    documents("a")
    rows = [(i, f"http://x/{i}", f"<html><body class='page {i}'>text number {i * i}</body>" * 9) for i in range(300)]
    folder = written(tmp_path, "dict")
    warc.write_archives(pages(spark, *rows), folder)
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(folder).first().content
    assert int.from_bytes(content[4:8], "little") > 1000
    assert warc.read_archives(spark, folder).count() == 300


def test_re_pair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    for letters, count in ((2, 3_000), (9, 5_000), (200, 20_000), (1, 500)):
        ids = rng.integers(0, letters, count).astype("<u4")
        ends = np.unique(np.append(rng.integers(0, count, 20), count - 1))
        grammar, symbols, stops = repair.compress(ids, ends)
        assert (repair.expand(symbols, grammar) == ids).all() and len(stops) == len(ends)
        lengths = [len(repair.expand(x, grammar)) for x in np.split(symbols, stops + 1)[:-1]]
        assert np.cumsum(lengths).tolist() == (ends + 1).tolist()
        seen, taken = Counter(), {}
        for i in sorted(set(range(len(symbols) - 1)) - set(stops.tolist())):
            pair = (symbols[i], symbols[i + 1])
            if taken.get(pair, -2) < i - 1:
                seen[pair] += 1
                taken[pair] = i
        assert max(seen.values(), default=0) < 8
    passage = np.tile(rng.integers(0, 1000, 128), 1_563).astype("<u4")
    grammar, symbols, _ = repair.compress(passage, np.array([len(passage) - 1]))
    assert len(symbols) < 32 and grammar.length.max() > 8_000
    assert (repair.expand(symbols, grammar) == passage).all()


def test_an_archive_is_read_in_small_steps(monkeypatch):
    """The library copies what stands behind a frame: with the rest of a file, that is the file per record."""
    real = zstandard.ZstdDecompressor

    class Watched:
        def __init__(self, one):
            self.one = one

        eof = property(lambda self: self.one.eof)
        unused_data = property(lambda self: self.one.unused_data)

        def decompress(self, some):
            sizes.append(len(some))
            return self.one.decompress(some)

    class Decompressor:
        def __init__(self, **options):
            self.decoder = real(**options)

        def decompressobj(self):
            return Watched(self.decoder.decompressobj())

    sizes = []
    monkeypatch.setattr(warc.zstandard, "ZstdDecompressor", Decompressor)
    rng = random.Random(1)
    bodies = [rng.randbytes(size) for size in [0, 1, 100, 5_000, 40_000] * 4]
    frames = []
    for i, body in enumerate(bodies):
        digest = hashlib.sha1(body).hexdigest()
        record = warc.Record(i, "u", "response", None, len(body), digest, body)
        frames.append(zstandard.ZstdCompressor().compress(warc.record_bytes(record)))
    content = struct.pack("<II", warc.SKIPPABLE, 0) + b"".join(frames)
    assert [r.payload for r in warc.archive_records(content)] == bodies
    assert max(sizes) <= warc.READ_BYTES
    with pytest.raises(warc.BadArchive, match="cut off"):
        list(warc.archive_records(content[:-1]))


def test_distinct_pairs_are_numbered_without_sorting_all():
    rng = np.random.default_rng(3)
    for keys in (np.zeros(0, np.int64), np.array([7]), rng.integers(0, 50, 1_000) << 24):
        wanted = np.unique(keys, return_inverse=True, return_counts=True)
        for got, right in zip(repair._numbered(keys), wanted, strict=True):
            assert got.tolist() == right.tolist()


def test_a_list_of_texts_sets_off_no_search_for_cycles():
    coder = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(20_000)]
    before = [x["collections"] for x in gc.get_stats()]
    found = coder.encode([" ".join(words), None])
    assert [x["collections"] for x in gc.get_stats()] == before and gc.isenabled()
    assert found == [coder._whole(" ".join(words)), b""]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_word_is_learned_once_whatever_mark_stands_beside_it(name):
    coder = Encoder(public_tokenizers.path(name))
    texts = ["so a thorn, a thorn. a thorn! a (thorn) a thorn;thorn a naïve, a naïve? a don't."]
    assert coder.encode(texts) == [coder._whole(texts[0])]
    assert [x for x in coder.known if "thorn" in x] == [" thorn", "thorn"]
    assert [x for x in coder.known if "naïve" in x] == [" naïve"] and " don't" in coder.known


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_are_cut_where_the_library_cuts(name):
    coder = Encoder(public_tokenizers.path(name), kept=300)
    rng = random.Random(7)
    alphabet = ["a", "É", "ÿ", "×", "÷", "'", "'s", "'ll", "=", "̸", "́", ".", "-", "7", "Σ", "й", "“", "中"]
    alphabet += [*" " * 6, *"\n\x0b\x1c\x85\xa0     　", "\0", "​", "😀", "x" * 60]
    given = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(2_000)]
    given = [None if i % 50 == 0 else text for i, text in enumerate(given)]
    for at in range(0, len(given), 100):
        found = coder.encode(pa.array(given, pa.string()).slice(at, 100))
        wanted = [b"" if text is None else coder._whole(text) for text in given[at : at + 100]]
        assert found == wanted
        assert len(coder.bounds) == len(coder.known) + 1 <= 301
        assert coder.bounds[-1] == len(coder.stored)
    assert coder.encode(pa.array([], pa.string())) == [] and coder.encode([None, ""]) == [b"", b""]


def test_a_full_dictionary_keeps_the_words_of_the_list():
    coder = Encoder(public_tokenizers.path("word_bpe_49k.json"), kept=40)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(60)]
    coder.encode([" ".join(words[:30])])
    later = " ".join(words[20:50])
    assert coder.encode([later]) == [coder._whole(later)]
    assert set(coder.known) == {f" {x}" for x in words[21:50]} | {words[20]}
    longer = " ".join(words) + " " + " ".join(words[::-1])
    assert coder.encode([longer, None]) == [coder._whole(longer), b""] and not coder.known


def test_known_pieces_are_held_without_an_object_each():
    rng = random.Random(9)
    words = sorted({"".join(rng.choices("abcdefgh", k=8)) for _ in range(40_000)})
    coder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode(["warm up"])
    gc.collect()
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    coder.encode([" ".join(words)])
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(coder.bounds) > len(words) and held < 80 * len(words)


def test_a_round_of_re_pair_only_looks_at_what_changed(monkeypatch):
    looked = []
    maybe_often = repair._maybe_often

    def watched(first, second, least):
        looked.append(len(first))
        return maybe_often(first, second, least)

    monkeypatch.setattr(repair, "_maybe_often", watched)
    rng = np.random.default_rng(4)
    once = rng.integers(1_000, 1 << 20, 50_000)
    passage = np.tile(rng.integers(0, 1_000, 64), 100)
    ids = np.concatenate([once, passage]).astype("<u4")
    grammar, symbols, _ = repair.compress(ids, np.array([len(once) - 1, len(ids) - 1]))
    assert (repair.expand(symbols, grammar) == ids).all()
    assert len(looked) > 6 and looked[0] == len(ids) - 1 and max(looked[1:]) <= len(passage)
