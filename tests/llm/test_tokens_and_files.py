"""Token ids equal the library's; shards and packed pieces give them back."""

import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from localpulse.llm import mixpack, repair
from localpulse.llm.core import HashTable, text_buffer
from localpulse.llm.queries import tokenizer_path
from localpulse.llm.tokens import encoder

ODD = ["", None, "don't I'M x'S '' 'sa", "a<|endoftext|>b <|x", "é́ Éx ́!“hi”—x", "Ünï 12.5%½ ×÷ÿ ÀÉß İΣας Σ", "\x1fa\x85b c　d\x00e", "!!,'..a'b...́ 1́ x́y", "日本語 한국 ｆｕｌｌ Ⅷ ²", "w" * 5000, "a b " * 3000, "Tab\tand\nline\r\nend"]


def plain_ids(text):
    return encoder(tokenizer_path()).tok.encode(text or "", add_special_tokens=False).ids


def split(texts):
    buf, offs = text_buffer(pa.array(texts, pa.string()))
    ids, n = encoder(tokenizer_path()).encode(buf, offs)
    stop = np.cumsum(n)
    return [ids[b - k : b].tolist() for b, k in zip(stop, n, strict=True)]


def test_odd_texts():
    assert split(ODD) == [plain_ids(t) for t in ODD]


def test_other_tokenizers_encode_whole_texts():
    other = encoder(tokenizer_path("byte_bpe_50k.json"))
    assert encoder(tokenizer_path()).by_pieces and not other.by_pieces
    buf, offs = text_buffer(pa.array(ODD, pa.string()))
    ids, n = other.encode(buf, offs)
    stop = np.cumsum(n)
    assert [ids[b - k : b].tolist() for b, k in zip(stop, n, strict=True)] == [other.tok.encode(t or "", add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=30), max_size=6))
def test_any_text(texts):
    assert split(texts) == [plain_ids(t) for t in texts]


def test_hash_table_grows():
    table = HashTable(3)
    keys = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in np.array_split(keys, 7):
        table.add(part)
    assert table.find(keys).tolist() == list(range(199)) and (table.find(keys + np.uint64(1)) < 0).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), max_size=40), min_size=1, max_size=12), st.data())
def test_grammar_round_trip(docs, data):
    n = np.array([len(d) for d in docs], np.int64)
    ids = np.array([x for d in docs for x in d], np.uint16)
    seq, rules, per_doc, made = repair.compress(ids, n, 7, min_count=2)
    payload, _ = repair.pack_shard(np.arange(len(docs)), n, ids, 7)
    shard = repair.Shard(payload)
    assert shard.ids().tolist() == ids.tolist() and per_doc.sum() == len(seq)
    for i, d in enumerate(docs):
        if d:
            a = data.draw(st.integers(0, len(d) - 1))
            b = data.draw(st.integers(a + 1, len(d)))
            assert shard.document(i, a, b).tolist() == d[a:b]


def test_grammar_of_a_large_vocabulary():
    rng = np.random.Generator(np.random.PCG64(6))
    phrase = rng.integers(0, 80_000, 40)
    docs = [np.concatenate([phrase, rng.integers(60_000, 80_000, 9)]) for _ in range(50)] + [np.array([70_000])]
    ids, n = np.concatenate(docs).astype(np.uint32), np.array([len(d) for d in docs])
    payload, symbols = repair.pack_shard(np.arange(len(docs)), n, ids, 80_000)
    shard = repair.Shard(payload)
    assert symbols < len(ids) / 2 and shard.ids().tolist() == ids.tolist()
    assert shard.document(50).tolist() == [70_000] and shard.document(7, 30, 45).tolist() == docs[7][30:45].tolist()
    with pytest.raises(ValueError, match="vocabulary"):
        repair.pack_shard(np.arange(1), np.array([1]), np.array([9]), 9)


def test_grammar_stops_only_when_done():
    """No pair within a document is left MIN_COUNT times while symbols are free."""
    rng = np.random.Generator(np.random.PCG64(7))
    ids = rng.zipf(1.3, 60_000).clip(0, 499).astype(np.uint16)
    n = np.full(60, 1000)
    seq, rules, per_doc, _ = repair.compress(ids, n, 500)
    last = set((np.cumsum(per_doc) - 1).tolist())
    pairs = Counter((int(a), int(b)) for i, (a, b) in enumerate(zip(seq[:-1], seq[1:], strict=True)) if i not in last and a != b)
    assert len(rules) < (1 << 16) - 500 and max(pairs.values()) < repair.MIN_COUNT


def test_grammar_compresses():
    ids = np.tile(np.array([1, 2, 3, 4], np.uint16), 2000)
    seq, rules, _, made = repair.compress(ids, np.array([len(ids)]), 10)
    assert len(seq) * 20 < len(ids)
    assert repair.expansion_lengths(rules, 10, made).max() >= 16


SCHEMA = "doc_id bigint, text string, source string, lang string, part int, shard int, ids string"
ROWS = [(5, "The cat sat. The cat sat.", "a", "x", 1, 1, "x"), (1, None, "b", "x", 1, 1, "x"), (3, "", None, "x", 1, 1, "x"), (7, "one two three " * 900, "a", "x", 1, 1, "x"), (7, "one two three " * 900, "a", "x", 1, 1, "x"), (9, "<|endoftext|> odd", "c", None, 1, 1, "x")]


def test_shards_give_ids_back(spark):
    got = sorted(map(tuple, repair.read_documents(repair.write_shards(spark.createDataFrame(ROWS, SCHEMA), tokenizer_path())).collect()), key=lambda r: r[1])
    want, at = [], 0
    for r in sorted(ROWS, key=lambda r: r[0]):
        ids = [*plain_ids(r[1]), 2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_shards_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.read_documents(repair.write_shards(empty, tokenizer_path())).count() == 0
    assert mixpack.pack(empty, tokenizer_path()).count() == 0


@pytest.mark.parametrize("weights", [None, {"a": 1.0, "b": 1.0, "c": 5.0}])
def test_packing_keeps_every_id(spark, weights):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = mixpack.pack(docs, tokenizer_path(), length=64, weights=weights).toPandas()
    by_window = rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (by_window.length.cumsum() - by_window.length.transform(lambda s: s)).reset_index(drop=True).tolist() == by_window.offset.apply(list).explode().tolist()
    sizes = by_window.length.sum()
    assert (sizes.iloc[:-1] == 64).all() and sizes.iloc[-1] <= 64
    want = sorted((r[0], len(plain_ids(r[1])) + 1) for r in ROWS)
    assert rows.length.sum() == sum(n for _, n in want)
    for r in rows.itertuples():
        text = next(x[1] for x in ROWS if x[0] == r.doc_id)
        ids = [*plain_ids(text), 1][r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32


def round_robin(queues, share, packet, length):
    """Pieces (window, source, first and last place) as counters stepped window by window send them, in fractions."""
    size = {q: sum(n for _, n in docs) for q, docs in queues.items()}
    given, sent, out, window = dict.fromkeys(queues, Fraction(0)), dict.fromkeys(queues, 0), [], 0
    while any(sent[q] < size[q] for q in queues):
        room = Fraction(length)
        while room and any(given[q] < size[q] for q in queues):
            live = [q for q in queues if given[q] < size[q]]
            pace = {q: share[q] / sum(share[x] for x in live) for q in live}
            step = min([room, *((size[q] - given[q]) / pace[q] for q in live)])
            for q in live:
                given[q] += step * pace[q]
            room -= step
        for q in sorted(queues):
            to = size[q] if given[q] == size[q] else given[q] // packet * packet
            if to > sent[q]:
                out.append((window, q, sent[q], to))
                sent[q] = to
        window += 1
    return out


@pytest.mark.parametrize(("length", "packet", "weights", "temper"), [(64, 1, None, 1.0), (64, 4, None, 0.5), (100, 300, None, 0.5), (50, 7, {"a": 3.0, "b": 1.0, "c": 1.0, "d": 0.5}, 1.0)])
def test_windows_against_stepped_counters(spark, length, packet, weights, temper):
    rng = np.random.Generator(np.random.PCG64(9))
    rows = [(i, "one two three four " * int(rng.integers(0, 60)), "abcd"[int(rng.choice(4, p=[0.5, 0.3, 0.15, 0.05]))]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1)
    got = mixpack.pack(docs, tokenizer_path(), length=length, packet=packet, weights=weights, temper=temper).toPandas().sort_values(["sequence_id", "offset"])
    queues = {}
    for i, text, q in rows:
        queues.setdefault(q, []).append((i, len(plain_ids(text)) + 1))
    share = {q: Fraction(w) for q, w in (weights or {q: sum(n for _, n in docs) ** temper for q, docs in queues.items()}).items()}
    ids = {q: [(d, k) for d, n in docs for k in range(n)] for q, docs in queues.items()}
    want = {q: [] for q in queues}
    for window, q, lo, hi in round_robin(queues, share, packet, length):
        want[q] += [window] * (hi - lo)
    have = {q: [] for q in queues}
    for r in got.itertuples():
        have[r.source] += [(r.doc_id, r.start + k, r.sequence_id) for k in range(r.length)]
    # Each queue comes in its own order, at most the shift of the window's edge away from the stepped window.
    for q in queues:
        assert [x[:2] for x in have[q]] == ids[q]
        shift = -(-packet * len(queues) // length)
        off = [abs(x[2] - w) for x, w in zip(have[q][: len(have[q]) - packet], want[q], strict=False)]
        assert max(off, default=0) <= shift
    # While no queue is dry, every window holds each source's share within a packet and the shift of its edges.
    total = sum(share.values())
    held = got.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    dry = min(got[got.source == q].sequence_id.max() for q in queues)
    for q in queues:
        assert (abs(held[q].loc[: dry - 1] - float(share[q] / total) * length) <= packet * (len(queues) + 1) + 1).all()


def test_default_windows_are_near_their_targets(spark):
    """Total variation distance of every window from the targets while no queue is dry, default packet and length, uneven sources."""
    rng = np.random.Generator(np.random.PCG64(4))
    docs = spark.createDataFrame([(i, "a b c d e f g h " * int(rng.integers(1, 120)), f"s{int(rng.zipf(1.3)) % 12:02d}") for i in range(900)], "doc_id bigint, text string, source string")
    rows = mixpack.pack(docs, tokenizer_path(), temper=0.7).toPandas()
    share = rows.groupby("source").length.sum() ** 0.7
    held = rows.pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    dry = rows.groupby("source").sequence_id.max().min()
    assert dry > 20
    distance = (held.loc[: dry - 1] / mixpack.WINDOW - share / share.sum()).abs().sum(axis=1) / 2
    assert distance.max() < 0.06
    # Once a queue is dry the others share its part by their own targets.
    for window in range(dry + 2, held.index.max() - 1):
        live = [q for q in share.index if rows[rows.source == q].sequence_id.max() > window + 1]
        if len(live) > 1 and held.loc[window, live].sum() == mixpack.WINDOW:
            assert (held.loc[window, live] / mixpack.WINDOW - share[live] / share[live].sum()).abs().sum() / 2 < 0.06


def test_targets_hold_in_every_window(spark):
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 40, "big" if i % 3 else "small") for i in range(60)], "doc_id int, text string, source string")
    rows = mixpack.pack(docs, tokenizer_path(), length=300, packet=20).toPandas()
    share = rows[rows.source == "small"].groupby("sequence_id").length.sum().iloc[:-1]
    assert share.between(80, 120).all() and abs(share.mean() - 100) < 2
    even = mixpack.pack(docs, tokenizer_path(), length=300, packet=20, weights={"big": 1.0, "small": 1.0}).toPandas()
    assert even[(even.source == "small") & (even.sequence_id < 30)].groupby("sequence_id").length.sum().between(130, 170).all()


@pytest.mark.parametrize("named", [False, True])
def test_every_source_has_a_queue(spark, named):
    """300 sources: each keeps pace with its share, and named minor ones come first."""
    docs = spark.createDataFrame([(i * 10 + k, "a b c d e f g h " * (2 if i >= 270 else 8), f"s{i:03d}") for i in range(300) for k in range(10)], "doc_id int, text string, source string")
    weights = {"s280": 1.0, "s000": 1.0} if named else None
    rows = mixpack.pack(docs, tokenizer_path(), length=1000, weights=weights).toPandas()
    assert rows.groupby("sequence_id").length.sum().iloc[:-1].eq(1000).all()
    if named:
        assert (rows[rows.source == "s280"].sequence_id == 0).all() and (rows[rows.source == "s000"].sequence_id <= 1).all()
        return
    rows["end"] = rows.sequence_id * 1000 + rows.offset + rows.length
    for _, own in rows.groupby("source"):
        own = own.sort_values("end")
        pace = own.length.cumsum() - own.end * own.length.sum() / rows.length.sum()
        assert (pace.abs() <= 65 + 1000 * own.length.sum() / rows.length.sum() + 2).all()


def test_long_text_is_packed_whole(spark):
    docs = spark.createDataFrame([(1, "word another " * 60_000, "a"), (2, "x", "b")], "doc_id bigint, text string, source string")
    rows = mixpack.pack(docs, tokenizer_path()).toPandas()
    assert rows.length.sum() == 120_003 and len(rows) < 70
    got = repair.read_documents(repair.write_shards(docs, tokenizer_path())).toPandas()
    assert got.n_tokens.tolist() == [120_001, 2]
