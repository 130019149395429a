"""Awkward inputs: nulls, empty and long texts, ties, repeated rows, empty tables, columns with clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

import brute
from weftgraph.llm import language_model, rans, suffix_array
from weftgraph.llm.components import components
from weftgraph.llm.decontaminate import decontaminate
from weftgraph.llm.exact_dedup import exact_dedup
from weftgraph.llm.jaccard_join import jaccard_components
from weftgraph.llm.language import LanguageModel, held_out, identify, labelled_sample, learned, training_steps
from weftgraph.llm.language_model import language_scores
from weftgraph.llm.license_scan import TEMPLATES, license_scan
from weftgraph.llm.mixing import integer_weights, mixed, round_schedule, source_key
from weftgraph.llm.substring_dedup import substring_dedup
from weftgraph.llm.suffix_dedup import suffix_dedup
from weftgraph.llm.token_files import TokenFileError, encoder, read_token_files, write_token_files
from weftgraph.scratch import Scratch

RNG = random.Random(3)
VOCABULARY = [w + t for w in ("al", "be", "ça", "do", "Ee", "fü", "漢字", "gh") for t in ("ro", "mi", "x,", "9")]


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(words))


PASSAGE, LONG = prose(40, 1), prose(30_000, 2)
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a b c"),
    (5, "A b C"),
    (6, PASSAGE),
    (7, PASSAGE.upper()),
    (8, PASSAGE),
    (8, PASSAGE),
    (9, prose(20, 3) + "\n" + PASSAGE + "\n" + prose(25, 4)),
    (10, LONG),
    (11, prose(9, 5) + " " + LONG[:4000]),
    (12, "x" * 5000),
    (13, "123 456 !!"),
    (None, PASSAGE),
    (None, None),
]
# Names that the operators use inside.
EXTRA = ["id", "row", "key", "label", "score", "anchor", "words", "place", "slot", "kept", "pack", "content", "salt"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    return frame.select("*", *[F.lit(i).alias(n) for i, n in enumerate(EXTRA)]).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect() if r["doc_id"] is not None}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def whole_digest(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.mark.parametrize("digest", [None, lambda text: F.pmod(F.crc32(text.cast("binary")), F.lit(3))])
def test_exact_dedup(spark, docs, digest):
    found = exact_dedup(docs, Scratch(spark), **({"digest": digest} if digest else {})).collect()
    texts = {d: lowered(t) for d, t in ROWS if d is not None}
    assert len(found) == len(ROWS)
    for r in found:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]]
        own = [d for d, t in ROWS if lowered(t) == text]
        best = max(d for d in own if d is not None)
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == (best, len(own), whole_digest(text))
        assert r["kept"] == (r["doc_id"] == best)


def test_exact_dedup_of_a_hot_group(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'Hot', string(id))").alias("text"))
    rows = exact_dedup(frame, Scratch(spark))
    assert rows.where("keep_id = 4998").count() == 1667 and rows.where("kept").count() == 3334


def removed_by_windows(rows, width):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first: dict[tuple, int] = {}
    for d, w in words:
        for i in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[i : i + width])
            first[key] = min(first.get(key, d), d)
    found = {}
    for d, w in words:
        gone = {i + k for i in range(len(w) - width + 1 if d is not None else 0) if first[tuple(w[i : i + width])] < d for k in range(width)}
        found[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return found


@pytest.mark.parametrize("width, gram", [(13, 5), (4, 2), (3, 3)])
def test_substring_dedup(spark, docs, width, gram):
    found = substring_dedup(docs, Scratch(spark), width=width, gram=gram)
    want = removed_by_windows(ROWS, width)
    assert found.count() == len(ROWS)
    assert by_id(found, "n_words", "n_removed", "kept") == {d: v for d, v in want.items() if d is not None}
    spans = by_id(found, "n_removed", "spans")
    assert all(n == sum(s["end"] - s["start"] for s in own) for n, own in spans.values())
    digests = by_id(substring_dedup(docs, Scratch(spark), width=width, gram=gram, as_digest=True), "kept")
    assert digests == {d: (whole_digest(v[2]),) for d, v in want.items() if d is not None}


@pytest.mark.parametrize("width, gram, split", [(400, 48, 2048), (25, 6, 2048), (25, 6, 1), (7, 7, 2)])
def test_suffix_dedup(spark, docs, width, gram, split):
    rows = suffix_dedup(docs, Scratch(spark), width=width, gram=gram, split=split, as_digest=True).collect()
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept"]) for r in rows)
    want = brute.bytes_removed([t for _, t in ROWS], width)
    assert got == sorted((d or -1, *v) for (d, _), v in zip(ROWS, want))
    kept = suffix_dedup(docs, Scratch(spark), width=width, gram=gram).select("kept").collect()
    assert sorted(whole_digest(bytes(r["kept"])) for r in kept) == sorted(v[3] for v in want)


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    for trial in range(150):
        text = [RNG.randrange(RNG.choice([1, 2, 4, 30])) for _ in range(RNG.randrange(60))]
        text = np.array(text + text[: len(text) // 2] * 2, dtype=np.int64)
        want = sorted(range(len(text)), key=lambda i: list(text[i:]))
        for least in (1, 24, 10**9):
            monkeypatch.setattr(suffix_array, "_ARRAYS_FROM", least)
            assert list(suffix_array.suffix_array(text)) == want
        before, common = suffix_array.permuted_common_prefixes(text, np.array(want, dtype=np.int64))
        for a, b in zip(want, want[1:]):
            length = next((k for k in range(len(text)) if max(a, b) + k >= len(text) or text[a + k] != text[b + k]), 0)
            assert (before[b], common[b]) == (a, length)


ITEMS = [(1, PASSAGE), (2, "A b, c"), (3, PASSAGE), (4, None), (5, "?!"), (None, prose(20, 3)), (6, prose(15, 99)), (10, "456")]


def contamination(rows, items, width=13):
    table = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
    words = lambda t: lowered(t).encode().translate(table).split()
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(item)
    found = {}
    for d, t in rows:
        w, hit, own = words(t), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    own |= windows[tuple(w[i : i + size])]
        ids = sorted(str(i) for i in own if i is not None)
        found[d] = (len(w), len(hit), len(ids), whole_digest(",".join(ids)), bool(hit) and 20 * len(hit) >= len(w))
    return found


def test_decontaminate(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("fp", F.lit(1))
    found = decontaminate(docs, items, Scratch(spark))
    assert found.count() == len(ROWS)
    want = contamination(ROWS, ITEMS)
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert by_id(found, *columns) == {d: v for d, v in want.items() if d is not None}
    assert decontaminate(docs, items.limit(0), Scratch(spark)).where("n_hit > 0 OR contaminated").count() == 0


def test_jaccard_components(spark, docs):
    found = jaccard_components(docs, Scratch(spark))
    assert found.count() == len(ROWS)
    want = brute.linked_components([(d, t) for d, t in ROWS if d is not None])
    assert by_id(found, "n_shingles", "component_id") == want


@pytest.mark.parametrize("percent", [30, 50, 101])
def test_jaccard_refuses_what_its_bounds_do_not_cover(spark, docs, percent):
    with pytest.raises(ValueError, match="percent"):
        jaccard_components(docs, Scratch(spark), percent=percent)


def near_copies():
    """Small and large sets, groups of near copies around a text, chains, and a passage that many share."""
    rng, rows = random.Random(8), []
    passage = prose(60, 50)
    for group in range(6):
        base = prose(rng.choice([6, 14, 30, 90, 200, 400]), 100 + group).split()
        for copy in range(25):
            words = list(base)
            for _ in range(rng.randrange(1 + len(words) // 12)):
                words[rng.randrange(len(words))] = f"n{rng.randrange(1000)}"
            rows.append(" ".join(words))
        base = base * 2
        for _ in range(12):
            base = base[len(base) // 15 :] + [f"c{rng.randrange(1000)}" for _ in range(1 + len(base) // 20)]
            rows.append(" ".join(base))
    rows += [prose(rng.randrange(5, 60), 900 + i) + " " + passage for i in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_jaccard_components_of_near_copies(spark):
    rows = near_copies()
    found = jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), Scratch(spark))
    assert by_id(found, "n_shingles", "component_id") == brute.linked_components(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 90), (95, 100)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(links, Scratch(spark)).collect()}
    assert found == {i: 0 for i in range(61)} | {90: 90, 95: 90, 100: 90}


def test_license_scan(spark):
    rows = [(1, f"x {t} y {u}") for t, u in zip(TEMPLATES.values(), list(TEMPLATES.values())[1:])]
    rows += [(2, "licensed under the APACHE license version 2 something else"), (3, None), (4, ""), (5, "MIT License")]
    rows += [(6, "Licensed under a license"), (None, "Released under the MIT License, Released under the MIT License")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("template", F.lit(0))
    found = {(r["doc_id"], r["template"]): (r["n_shingles"], r["n_found"], r["word"]) for r in license_scan(frame).collect()}
    assert {t for d, t in found if d == 1} == set(TEMPLATES)
    assert found[2, "apache-2.0"] == (4, 3, 0) and found[None, "mit"] == (1, 1, 0)
    assert {d for d, _ in found} == {1, 2, None}


def test_license_scan_of_whole_licenses_and_short_texts(spark):
    rng = random.Random(12)
    words = [f"w{rng.randrange(900)}" for _ in range(5600)]
    spoilt = [w if i % 40 else "changed" for i, w in enumerate(words)]
    other = [f"v{rng.randrange(900)}" for _ in range(300)]
    notice = TEMPLATES["bsd"].split()
    rows = [(1, other + words + other), (2, spoilt), (3, words[:4500]), (4, words[:4100]), (5, other + words[700:720] + other), (6, notice[:-2]), (7, notice[:8])]
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id bigint, text string")
    found = license_scan(frame, templates={"long": " ".join(words), "bsd": TEMPLATES["bsd"]}).collect()
    cut = lambda own: [" ".join(own[i : i + 5]) for i in range(len(own) - 4)]
    wanted = {"long": set(cut(words)), "bsd": set(cut(TEMPLATES["bsd"].lower().replace(",", "").split()))}
    got = {(r["doc_id"], r["template"]): (r["n_shingles"], r["n_found"]) for r in found}
    assert got[1, "long"] == (len(wanted["long"]), len(wanted["long"]))
    for d in (2, 3):
        assert got[d, "long"] == (len(wanted["long"]), len(wanted["long"] & set(cut(dict(rows)[d]))))
    assert got[6, "bsd"] == (len(wanted["bsd"]), len(wanted["bsd"]) - 2)
    assert set(got) == {(1, "long"), (2, "long"), (3, "long"), (6, "bsd")}
    assert license_scan(frame, short_texts=False).where("template = 'bsd'").count() == 0


def test_language_model_scores(spark, docs):
    found = language_scores(docs, Scratch(spark)).collect()
    assert len(found) == len(ROWS)
    tokens = [(d, lowered(t).encode().split() + [None]) for d, t in ROWS]
    training = [w for d, own in tokens if zlib.crc32(str("" if d is None else d).encode()) % 7 != 2 for w in own]
    total, kinds = len(training), len(set(training))
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found)
    times = {w: training.count(w) for w in set(training)} if total < 10**4 else dict(zip(*np.unique([str(w) for w in training], return_counts=True)))
    count = lambda w: times.get(w, 0) if total < 10**4 else times.get(str(w), 0)
    base = lambda own: float(sum(np.log10((count(w) + 1) / (total + kinds + 1)) for w in own))
    want = sorted((d or -1, len(own), sum(count(w) > 0 for w in own), total, round(base(own), 6)) for d, own in tokens)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], atol=1e-5)
    assert all(r["score"] < 0 for r in found)


def test_language_model_is_a_distribution(spark):
    random_counts = np.random.default_rng(1).integers(0, 50, language_model.CONTEXTS * language_model.CLASSES)
    from weftgraph.llm import counts

    chunk = counts.chunked(random_counts, (language_model.CLASSES + 1) * language_model.CLASSES)
    import pyarrow as pa

    seen = spark.createDataFrame(pa.Table.from_batches([chunk]))
    totals = random_counts.reshape(-1, language_model.CLASSES).sum(axis=0).astype(float)
    plain = language_model.trained(seen, totals, updates=0)
    better = language_model.trained(seen, totals, updates=4)
    assert np.allclose(np.exp(better).sum(axis=1), 1)
    likelihood = lambda logs: (random_counts.reshape(logs.shape) * logs).sum()
    assert likelihood(better) > likelihood(plain)


def test_language_identification(spark, docs):
    french = ["été à la plage où ça va être forêt"] * 30
    english = ["the thing with which they were thinking that"] * 30
    model = learned([t.encode() for t in french + english], ["fr"] * 30 + ["en"] * 30)
    found = identify(docs, model)
    assert found.count() == len(ROWS)
    rows = by_id(found, "lang_pred", "score")
    assert all(rows[d] == ("und", 0.0) for d in (1, 2, 3, 13))
    assert all(0 < rows[d][1] <= 1 and rows[d][0] in ("fr", "en") for d in (4, 6, 10, 12))
    whole = model.pooled([french[0].encode() * 40, b"", english[0].encode() * 900])
    assert whole[0].argmax() == 1 and whole[2].argmax() == 0 and whole[1].sum() == 0
    assert identify(docs, LanguageModel([], None, None, None)).where("lang_pred != 'und' OR score != 0").count() == 0
    kept = identify(docs, model, keep=True)
    assert kept.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]


def test_language_labels_are_sampled_from_training_rows(spark):
    frame = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
        F.expr("CASE WHEN id % 10 = 0 THEN null WHEN id % 3 = 0 THEN 'rare' ELSE 'common' END").alias("lang"),
    )
    texts, labels = labelled_sample(frame)
    assert {labels.count(x) for x in set(labels)} == {400}
    ids = [int(t.split()[1]) for t in texts]
    assert len(set(ids)) == 800 and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
    assert frame.where(held_out(F.col("doc_id"))).count() == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(3000))


def test_every_label_is_learned(spark):
    names = "concat('l', id % 300)"
    frame = spark.range(3000).selectExpr("id AS doc_id", f"concat('text ', {names}) AS text", f"{names} AS lang")
    texts, labels = labelled_sample(frame)
    assert len(set(labels)) == 300 and all(t.decode() == f"text {n}" for t, n in zip(texts, labels))
    assert training_steps(4) == 160 and training_steps(300) >= 1500


def ideal_and_lag(order, weights, blocks):
    """The largest distance of any source from the even mix, at any slot."""
    done, ideal, worst = dict.fromkeys(blocks, 0), dict.fromkeys(blocks, 0.0), 0.0
    for s in order:
        left = 1.0
        while left > 1e-9:
            active = [x for x in blocks if blocks[x] - ideal[x] > 1e-9]
            rate = sum(weights[x] for x in active)
            step = min([left / rate, *[(blocks[x] - ideal[x]) / weights[x] for x in active]])
            for x in active:
                ideal[x] += weights[x] * step
            left -= step * rate
        done[s] += 1
        worst = max(worst, *[abs(done[x] - ideal[x]) for x in blocks])
    return worst


@pytest.mark.parametrize("weights, sizes", [({"a": 5, "b": 3, "c": 1}, {"a": 40, "b": 90, "c": 7}), ({"a": 1, "b": 1}, {"a": 1, "b": 64})])
def test_mixing_stays_within_a_block_of_the_targets(spark, weights, sizes):
    rows = [(i, s, s + str(i)) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n * 3 - 1))]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, slot string")
    keyed = {source_key(s): w for s, w in weights.items()}
    placed = mixed(frame, keyed, Scratch(spark), block_rows=3, rows_per_range=50).select("row.*", F.col("slot").alias("at"), "place", "source_block")
    found = placed.collect()
    assert sorted(r["slot"] for r in found) == sorted(r[2] for r in rows)
    slots = {}
    for r in found:
        slots.setdefault(r["at"], set()).add((r["source"], r["source_block"]))
    assert sorted(slots) == list(range(sum(sizes.values()))) and all(len(v) == 1 for v in slots.values())
    order = [next(iter(slots[s]))[0] for s in sorted(slots)]
    parts = integer_weights(keyed)
    assert ideal_and_lag(order, {s: parts[source_key(s)] for s in weights}, sizes) < 1


@pytest.mark.parametrize(
    "weights, sizes",
    [({"a": 5, "b": 3, "c": 1}, {"a": 5000, "b": 3100, "c": 900}), ({"a": 1000**0.7, "b": 0.01}, {"a": 6000, "b": 3})],
)
def test_mixing_follows_the_target_weights_over_many_slots(spark, weights, sizes):
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string")
    placed = mixed(frame, {source_key(s): w for s, w in weights.items()}, Scratch(spark), block_rows=1)
    found = placed.select("slot", "row.source").orderBy("slot").collect()
    assert [r["slot"] for r in found] == list(range(len(rows)))
    assert ideal_and_lag([r["source"] for r in found], weights, sizes) < 1


def test_mixing_awkward_rows(spark, docs):
    frame = docs.withColumn("source", F.expr("CASE WHEN doc_id % 2 = 0 THEN 'even' WHEN doc_id > 5 THEN 'odd' END"))
    weights = {source_key("even"): 2.0, source_key("odd"): 1.0, source_key(None): 0.5, source_key("absent"): 9.0}
    placed = mixed(frame, weights, Scratch(spark), block_rows=2)
    assert placed.count() == len(ROWS) and placed.select("row.*").columns == frame.columns
    assert placed.select("slot", "place").distinct().count() == len(ROWS)
    with pytest.raises(ValueError, match="no weight"):
        mixed(frame, {source_key("even"): 1.0}, Scratch(spark))


def test_round_schedule_meets_releases_and_deadlines():
    weights = {"a": 7, "b": 5, "c": 3, "d": 1}
    order = round_schedule(weights, weights)
    total = sum(weights.values())
    for slot, (s, k) in enumerate(order):
        assert k * total // weights[s] <= slot < -(-(k + 1) * total // weights[s])


def test_coder_round_trip():
    random_ids = np.random.default_rng(4)
    for n, kinds in ((0, 5), (1, 1), (1000, 3), (rans.LANES * rans.INTERVAL * 2 + 77, 50_000)):
        ids = np.minimum(random_ids.geometric(0.001, n), kinds).astype(np.uint32) - 1
        coder = rans.Coder(rans.frequencies(np.bincount(ids, minlength=max(kinds, 1))))
        stream, places, states = coder.encode(ids)
        for start in range(len(places)):
            back = coder.decode(stream, n, places, states, start)
            assert (back == ids[start * rans.LANES * rans.INTERVAL :]).all()


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    out, scratch = str(tmp_path / "tokens"), Scratch(spark)
    write_token_files(docs, out, tokenizer_path("byte_bpe_50k.json"), 2, 50_257)
    rows = read_token_files(spark, out, scratch, 50_257).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in ROWS), key=lambda d: -1 if d is None else d)
    at = 0
    for r in rows:
        own = [t or "" for d, t in ROWS if d == r["doc_id"]]
        assert r["start"] == at and r["ids"] in [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in own]
        at += len(r["ids"])
    digests = read_token_files(spark, out, scratch, 50_257, as_digest=True).orderBy("start").collect()
    for r, d in zip(rows, digests):
        raw = np.array(r["ids"], dtype="<u4").tobytes()
        assert (d["doc_id"], d["start"], d["n_tokens"], d["ids_crc32"]) == (r["doc_id"], r["start"], len(r["ids"]), zlib.crc32(raw))
    blocks = spark.read.parquet(f"{out}/blocks")
    spoilt = blocks.withColumn("stream", F.concat(F.expr("substring(stream, 5)"), F.unhex(F.lit("00000000"))))
    spoilt.write.parquet(str(tmp_path / "bad/blocks"))
    spark.read.parquet(f"{out}/table").write.parquet(str(tmp_path / "bad/table"))
    with pytest.raises(Exception, match=TokenFileError.__name__):
        read_token_files(spark, str(tmp_path / "bad"), scratch, 50_257).collect()


def test_pieces_are_encoded_as_their_text_is():
    coder = encoder(tokenizer_path("byte_bpe_50k.json"))
    hard = ["a  b \n c  ", " x y", "\n\na\nb\n c", "don't 'll <|endoftext|>\nx", "é è　ü \x1c b", "\0a \0b\n\0", "", " ", "\n"]
    hard += [" ".join(RNG.choice(["a", "", "\n", "b,", "\t", "'s", " "]) for _ in range(12)) for _ in range(300)]
    want = [e.ids for e in coder.tokenizer.encode_batch(hard, add_special_tokens=False)]
    assert [list(ids) for ids in coder.encode(hard)] == want


def test_empty_tables(spark, nothing):
    scratch = lambda: Scratch(spark)
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    for frame in (
        exact_dedup(nothing, scratch()),
        substring_dedup(nothing, scratch()),
        suffix_dedup(nothing, scratch()),
        decontaminate(nothing, items, scratch()),
        jaccard_components(nothing, scratch()),
        license_scan(nothing),
        language_scores(nothing, scratch()),
        identify(nothing, learned(*labelled_sample(nothing))),
        mixed(nothing, {}, scratch()),
    ):
        assert frame.count() == 0
    out, own = scratch().folder("tokens"), scratch()
    write_token_files(nothing, out, tokenizer_path("byte_bpe_50k.json"), 2, 50_257)
    assert read_token_files(spark, out, own, 50_257).count() == 0
