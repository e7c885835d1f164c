"""Token files, the conversation trie and the alignment of tokenizers against brute force, with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from comboscope.llm import alignment, tokenfiles, trie

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, part int, file string, seq string, ids int"


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdeéß,.X\n日😀", k=rng.randint(1, 7))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(40)]
    texts += [None, "", " ", "  two  spaces ", " lead", "trail ", "a\n b\t c", "<|endoftext|> x<|endoftext|>", "<s> </s> <0x0A>", "▁x", "no break wide", "x\u0000y", "same", "same",
              "z" * 3000, " ".join(texts[:40]) * 3, "ﬁ Å Å", "​zero", "é", "\n", "İ ½ ①"]
    rows = [(i - 5, t, 1, "f", "s", 2) for i, t in enumerate(texts)] + [(3, "three again", 1, "f", "s", 2), (None, "no id", 1, "f", "s", 2), (None, None, 1, "f", "s", 2), (7, "same", 1, "f", "s", 2)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_elias_fano_selects():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (1, 1 << 62), (200, 1), (200, 3), (1000, 1 << 20), (5000, 1 << 63), (64, 64), (65, 1 << 40)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        code = tokenfiles.EliasFano.from_bytes(memoryview(tokenfiles.EliasFano.of(values).to_bytes()))
        order = rng.permutation(n)
        assert (code.select(order) == values[order]).all(), (n, top)
    values = np.concatenate([np.arange(500), np.full(500, 10**6)]).astype(np.uint64)  # a gap, then ties
    code = tokenfiles.EliasFano.of(values)
    assert (code.select(np.arange(1000)) == values).all()
    many = np.cumsum(rng.integers(1, 900, 100_000))
    assert len(tokenfiles.EliasFano.of(many).to_bytes()) * 8 < 100_000 * (2 + np.log2(450) + 1.5)


@pytest.mark.parametrize("segment", [200, 1 << 22])
def test_token_files_give_all_ids_back(spark, docs, none, tmp_path, segment):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A)
    path = str(tmp_path / "files")
    tokenfiles.write(docs, path, A, P.PATTERN, segment=segment)
    got = tokenfiles.read(spark, path, with_ids=True).orderBy("start").collect()
    ids = {(r.doc_id, r.text): library.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0, ids[r.doc_id, r.text]) for r in docs.collect())
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), crc(r.ids))
        at += r.n_tokens
    files = sorted((tmp_path / "files").glob("part-*"))
    assert len(files) > 10 or segment > 200
    one = tokenfiles.Segment(files[0].read_bytes())
    assert one.document(1).tolist() == [r for r in got if r.doc_id == one.doc_ids()[1].as_py()][0 if one.doc_ids()[1].as_py() is not None else 1].ids
    empty = str(tmp_path / "empty")
    tokenfiles.write(none, empty, A, P.PATTERN)
    assert tokenfiles.read(spark, empty).collect() == []


def test_token_files_keep_ids_of_other_types(spark, tmp_path):
    rows = [("b", "one two"), ("a", None), (None, "x"), ("a", "y")]
    tokenfiles.write(spark.createDataFrame(rows, "name string, body string"), str(tmp_path / "f"), A, P.PATTERN, "name", "body")
    assert [r.doc_id for r in tokenfiles.read(spark, str(tmp_path / "f"), "string").orderBy("start").collect()] == [None, "a", "a", "b"]
    with pytest.raises(ValueError):
        tokenfiles.Segment(b"cut off")


def brute_trie(sequences):
    """Nodes of {id: [(role, text), ...]} as plain prefixes."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for key, ids in members.items():
        below = [k for k in members if k[: len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaf = lambda k: not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below)
        ends = ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(key))
        out.append((min(ids), len(key), min(members[key[:-1]]) if key else None, len(ids), len(children), sum(map(leaf, below)),
                    sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    h = lambda c: zlib.crc32(str(c).encode()) % 6
    return {c: own.get(c - c % 100, [])[: h(c)] + turns[h(c):] for c, turns in own.items()}


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("part", [4, 512])
def test_trie_equals_plain_prefixes(spark, monkeypatch, part):
    monkeypatch.setattr(trie, "PART", part)
    monkeypatch.setattr(trie, "PIECE", 20)
    rng = random.Random(5)
    say = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "long text", "", None, "😀"]))
    rows = []
    for c in [*range(0, 40), *range(101, 130), 200, 205, 333, 777, 778]:
        for turn in range(rng.choice([1, 2, 4, 5, 6, 8, 9, 17])):
            rows.append((c, turn, *say()))
    rows += [(c, t, "user", "same") for c in range(400, 420) for t in range(16)]  # one path, many members
    rows += [(500, t, "user", f"x{t % 3}") for t in range(40)] + [(500, None, "system", "first"), (None, 1, "user", "nobody"), (600, 1, "user", "twice"), (600, 1, "user", "twice")]
    rng.shuffle(rows)
    data = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, seq int, pos string, n1 int").repartition(4)
    got = trie.prefix_trie(*trie.forked(trie.ordered_turns(data)))
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=repr) == brute_trie(rebuilt(rows))


def test_trie_of_turnless_and_no_conversations(spark):
    turns = "conv_id long, turn long, role string, text string"
    empty = trie.prefix_trie(*trie.forked(trie.ordered_turns(spark.createDataFrame([], turns))))
    assert empty.columns == COLUMNS and empty.collect() == []
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0)  # no first conversation, its one turn is cut off
    got = trie.prefix_trie(*trie.forked(trie.ordered_turns(spark.createDataFrame([(lone, 0, "user", "x")], turns)))).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_prefix_names_agree_with_prefixes():
    rng = np.random.default_rng(2)
    sequences = [rng.integers(0, 2, rng.integers(0, 40)) for _ in range(300)]
    sequences = [s for s in sequences if len(s)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
    names = trie.prefix_names(np.stack([np.concatenate(sequences)] * 2).astype(np.uint64), offsets, np.zeros((2, len(sequences)), np.uint64))
    seen = {}
    for s, a in zip(sequences, offsets, strict=False):
        for d in range(1, len(s) + 1):
            assert seen.setdefault(tuple(s[:d]), tuple(names[:, a + d - 1])) == tuple(names[:, a + d - 1])
    assert len(set(seen.values())) == len(seen)


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel  # noqa: F401

    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    byte = {c: b for c, b in alignment.Encoder.__init__.__globals__["_byte_symbols"]().items()}
    name = {i: bytes(byte[c] for c in t) for t, i in a_lib.get_vocab().items() if "<|" not in t}
    piece = lambda i: bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for d, t in rows:
        a = a_lib.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_lib.encode(t) if t else []
        if not t or not b"".join(map(name.get, a)) == b"".join(map(piece, b)) == b" " + t.encode():
            found.append((d, [], [], [], ""))
            continue
        ends = [np.cumsum([len(x) for x in y]).tolist() for y in (map(name.get, a), map(piece, b))]
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b))
                 if max(([0] + ends[0])[i], ([0] + ends[1])[j]) < min(ends[0][i], ends[1][j])] if len(a) < 400 else None
        if links is None:  # long: by walking both lists
            links, i, j = [], 0, 0
            while i < len(a) and j < len(b):
                links.append((a[i], b[j]))
                x, y = ends[0][i], ends[1][j]
                i, j = i + (x <= y), j + (y <= x)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in common:
            i2, j2 = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        counts.update(links)
        found.append((d, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups)))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(f[0], len(f[1]), len(f[2]), f[5] if f[1] else 0, len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), f[4]) for f in found]


@pytest.mark.parametrize("block", [500, 3 << 20])
def test_alignment_equals_overlaps(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    got = alignment.align(docs, A, P.PATTERN, B).collect()
    want = brute_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert alignment.align(none, A, P.PATTERN, B).collect() == []


def test_alignment_links_a_part_of_the_encoded_text_at_a_time(monkeypatch):
    """Lists that link the tokens of 3 MiB at once took 226 MB besides the tokenizers, in every Python worker."""
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=1500)) for _ in range(300)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], ["doc_id", "text"])
    alignment._pair(A, P.PATTERN, B)
    tracemalloc.start()
    found = [i for b in alignment._blocks(A, P.PATTERN, B)(iter([rows])) for i in b["doc_id"][0].as_py()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == list(range(300)) and peak < 160e6


def test_galloping_finds_first_places():
    rng = np.random.default_rng(4)
    for sizes in ([(3, 5), (1, 1), (700, 9000)], [(5000, 5001)], [(1, 100_000), (200, 200)]):
        short = [np.sort(rng.choice(200_000, a, replace=False)) for a, _ in sizes]
        long = [np.sort(rng.choice(200_000, b, replace=False)) for _, b in sizes]
        long = [np.unique(np.append(x, 200_000)) for x in long]
        cuts = [np.concatenate([[0], np.cumsum([len(x) for x in y])]) for y in (short, long)]
        base = np.arange(len(sizes)) * 300_000
        got = alignment.ranks(np.concatenate([x + b for x, b in zip(short, base, strict=True)]), cuts[0], np.concatenate([x + b for x, b in zip(long, base, strict=True)]), cuts[1])
        want = np.concatenate([np.searchsorted(y, x) + c for x, y, c in zip(short, long, cuts[1], strict=False)])
        assert (got == want).all()
