"""Each operator against a plain version on small inputs, odd rows included."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ordersmith.llm import common, fingerprints, hmm, jaccard, mixing, packing, rules, token_counts, toxicity, warc, weak_labels
from ordersmith.llm.common import fold, table
from tests.conftest import MEDIUM, SMALL, physical_plan
from tests.llm.test_jaccard import brute, near_groups

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(0, None), (1, ""), (2, " \n\t"), (3, "Ein Wort"), (4, "it's I'M they'reabc ''s 12a3"), (5, "é́ 日本語 <|endoftext|> x"), (6, "a b c d e f g " * 900), (7, "a b c d e f g " * 900), (7, "same id"), (None, "no id")]


@pytest.fixture(scope="module")
def odd(docs_of):
    return docs_of(ODD, extra=True)


def test_packing(llm, odd):
    tok = Tokenizer.from_file(TOKENIZER)
    for rows, df in ((ODD, odd), (None, table(llm, SMALL, "documents"))):
        rows = rows or [(r["doc_id"], r["text"]) for r in df.collect()]
        got = packing.pack(df, TOKENIZER).collect()
        want = Counter()
        for i, t in rows:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
            for k, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at:at + 4096]
                want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
        seqs = {}
        for r in got:
            seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for s in seqs.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(seqs) == packing.lower_bound(Counter(r["length"] for r in got))
    assert packing.pack(odd.limit(0), TOKENIZER).count() == 0


def test_packing_without_short_pieces():
    """Never worse than plain best fit decreasing, piece by piece; the optimum where best fit misses it."""
    def plain(lengths, capacity):
        rooms = []
        for x in sorted(lengths, reverse=True):
            k = min((k for k, r in enumerate(rooms) if r >= x), key=lambda k: rooms[k], default=None)
            if k is None:
                rooms.append(capacity - x)
            else:
                rooms[k] -= x
        return len(rooms)

    rng = np.random.default_rng(5)
    mixes = [(4096, rng.integers(400, 3001, 600).tolist()), (4096, rng.integers(700, 1500, 400).tolist()), (10, [6, 5, 4, 3, 2] * 3), (10, [5, 4, 4, 3, 2, 2] * 2), (7, [])]
    for capacity, lengths in mixes:
        h = Counter(lengths)
        best = packing.best_fit(h, capacity)
        assert sum(n for _, n in best) == plain(lengths, capacity)
        for patterns in (best, packing.solve(h, capacity, work=30_000)):
            used = Counter()
            for p, n in patterns:
                assert n > 0 and sum(p) <= capacity
                used.update({k: v * n for k, v in Counter(p).items()})
            assert used == h
        assert packing.lower_bound(h, capacity) <= sum(n for _, n in patterns) <= plain(lengths, capacity)
    assert sum(n for _, n in packing.solve(Counter([5, 4, 4, 3, 2, 2] * 2), 10)) == 4
    assert packing.dominates((5, 3), (3, 3, 2)) and not packing.dominates((4, 4), (5, 3))


def test_token_counts_after_edits(odd):
    tok = Tokenizer.from_file(TOKENIZER)
    count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    got = Counter((r["doc_id"], r["n_tokens"], r["n_tokens_edited"]) for r in token_counts.counts_after_edits(odd, TOKENIZER, token_counts.sample_edits).collect())
    want = Counter()
    for i, t in ODD:
        t = now = t or ""
        for a, z, new in token_counts.sample_edits(i, t):
            a, z = min(a, len(now)), max(min(a, len(now)), min(z, len(now)))
            now = now[:a] + new + now[z:]
        want[i, count(t), count(now)] += 1
    assert got == want


def test_fingerprints(llm, odd):
    d = table(llm, SMALL, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in d.collect())
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(d).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for w in (WORD.findall(t), WORD.findall(edited)))
        assert abs(got[i]["near_edited"] - len(a & b) / len(a | b)) < 0.25
    assert fingerprints.fingerprint_edits(odd).count() == len(ODD)
    assert fingerprints.fingerprint_edits(odd.limit(0)).count() == 0


def test_fingerprints_find_near_duplicates(docs_of, monkeypatch):
    """Groups whose ids are not neighbours, against brute force on full sets; small and hot buckets, odd rows."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = near_groups(5, 8, 24)
    step = 37 if len(rows) % 37 else 41  # spreads each group over the ids
    rows = [(k * step % len(rows), t) for k, (_, t) in enumerate(rows)] + [(10_000, None), (10_001, " "), (10_002, "one two"), (10_003, "one  two"), (10_004, "alone")]
    want = brute(rows)
    assert len({c for c, _ in want.values()}) < len(rows) / 2
    got = {r["doc_id"]: r["class_id"] for r in fingerprints.fingerprint_edits(docs_of(rows, extra=True)).collect()}
    assert got == {i: c for i, (c, _) in want.items()}


def plain_stats(t):
    w = WORD.findall(t or "")
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    win = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    cover = {k + j for k in range(len(w) - 4) if win[tuple(w[k:k + 5])] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover)


def test_text_statistics(llm, odd):
    for df in (odd, table(llm, MEDIUM, "documents")):
        want = Counter((r["doc_id"], *plain_stats(r["text"])) for r in df.select("doc_id", "text").collect())
        cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert Counter(tuple(r) for r in rules.text_stats(df).select(*cols).collect()) == want


def test_rules_and_weak_labels_find_the_bad_texts(llm, odd):
    d, lab = table(llm, MEDIUM, "documents"), table(llm, MEDIUM, "labels")
    r = rules.apply_rules(d, rules.learn_rules(d, lab)).join(lab, "doc_id").where("not base_failed")
    assert r.where((F.col("quality") == 1) != F.col("kept")).count() <= 0.02 * r.count()
    s = weak_labels.classify(d).join(lab, "doc_id")
    assert s.where((F.col("quality") == 1) != F.col("kept")).count() <= 0.02 * s.count()
    none = lab.limit(0)
    assert rules.apply_rules(odd, rules.learn_rules(odd, none)).count() == len(ODD)
    assert weak_labels.keep_good(odd).columns == odd.columns
    assert weak_labels.classify(odd.limit(0)).count() == 0


def test_toxicity(llm, odd):
    d, lab = table(llm, MEDIUM, "documents"), table(llm, MEDIUM, "labels")
    g = toxicity.train(d, lab, fold(F.col("l_id"), 5) != 0)
    s = toxicity.score(d, g).join(lab, "doc_id")
    assert s.where("toxic <> predicted").count() <= 0.04 * s.count()
    assert s.where("toxic = 0 and predicted = 1").count() <= 0.01 * s.count()
    assert toxicity.score(odd, g).count() == len(ODD)
    assert toxicity.keep_clean(odd, toxicity.train(odd, lab.limit(0))).count() == len(ODD)


def test_grammar_marks():
    t, out, state = toxicity.grammar(), [], 0
    for symbol in (toxicity.TARGET, toxicity.NEGATION, toxicity.OTHER, toxicity.INSULT, *[toxicity.OTHER] * 5, toxicity.REPORT, toxicity.INSULT):
        state, form = t.step(state, symbol)
        out.append(form)
    assert out[3] == toxicity.INSULT | toxicity.NEGATED | toxicity.AIMED
    assert out[-1] == toxicity.INSULT | toxicity.REPORTED | toxicity.AIMED


def test_language_model(llm, odd):
    d = table(llm, MEDIUM, "documents")
    rows = [(r["doc_id"], r["text"]) for r in d.collect()]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, held = Counter(), {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    for i, t in rows:
        if not held[i]:
            seen.update([*WORD.findall(t.translate(low)), None])
    n, v = sum(seen.values()), len(seen)
    got = {r["doc_id"]: r for r in hmm.score(d, fold(F.col("doc_id"), 7) == 2).collect()}
    gain = 0.0
    for i, t in rows:
        tok = [*WORD.findall(t.translate(low)), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(tok), sum(x in seen for x in tok), n)
        assert math.isclose(r["base_score"], sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in tok), rel_tol=1e-9)
        gain += (r["score"] - r["base_score"]) * held[i]
    assert gain > 0
    assert hmm.score(odd, F.lit(False)).count() == len(ODD)
    assert hmm.score(odd.limit(0), F.lit(False)).count() == 0


def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(2)
    m = hmm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(4), 3).T)
    seqs = [rng.integers(0, 4, k) for k in (5, 1, 3)]
    off = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    for s, got in zip(seqs, hmm.forward_log10(m, np.concatenate(seqs), off), strict=True):
        total = 0.0
        for path in np.ndindex(*[3] * len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for k in range(1, len(s)):
                p *= m.step[path[k - 1], path[k]] * m.emit[s[k], path[k]]
            total += p
        assert math.isclose(got, math.log10(total), rel_tol=1e-9)


def test_mixing_reaches_its_budget(llm, odd):
    d = table(llm, MEDIUM, "documents")
    got = mixing.mix_sources(d)
    total = mixing.leaves_of(d).agg(F.sum("tokens")).first()[0]
    assert 0.49 * total < got.agg(F.sum("taken")).first()[0] <= 0.5 * total
    assert mixing.mix_sources(odd).where("taken > tokens or taken < 1").count() == 0
    assert mixing.mix_sources(odd.limit(0)).count() == 0


@pytest.mark.parametrize("mix", [mixing.PRODUCTION, mixing.Mix(share=0.9, epochs=1), mixing.Mix(share=0.0004), mixing.Mix(share=0.0), mixing.Mix(share=1.7, epochs=3)])
def test_mixing_keeps_the_documents_it_takes(llm, odd, mix):
    clash = [F.lit(1).alias(c) for c in ("m_lang", "m_last", "last", "key", "epoch", "slice", "tokens", "domain", "h")]
    for df in (table(llm, MEDIUM, "documents").select("*", *clash), odd, odd.union(odd).select("*", *clash), odd.limit(0)):
        want = {r["doc_id"] for r in mixing.mix_sources(df, mix).select("doc_id").distinct().collect()}
        got = mixing.keep_mixed(df, mix)
        assert got.columns == df.columns
        got, rows = Counter(got.collect()), Counter(df.collect())
        assert {r["doc_id"] for r in got} == want
        # rows stay as they are, with all their repeats
        assert all(rows[r] == n for r, n in got.items())


def test_texts_are_not_sorted_beyond_the_broadcast(llm, monkeypatch):
    monkeypatch.setattr(common, "SENT", 0)
    d = table(llm, SMALL, "documents")
    ids = common.written(d.select(F.col("doc_id").alias("i")).where("doc_id % 3 = 0"), "test-ids")
    got = d.join(common.sendable(ids), d["doc_id"] == ids["i"], "left_anti")
    plan = physical_plan(got)
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert got.count() == d.where("doc_id % 3 <> 0").count()


def test_warc_round_trip(llm):
    big = "x" * 1500
    rows = [(1, "u", big), (2, None, big), (3, "u\r\nv", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (6, "u", "ü" * 200_000), (6, "u", "ü" * 200_000)]
    pages = llm.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, record int")
    got = warc.archive_pages(pages).collect()
    assert len(got) == len(rows) and all(r["digest_ok"] for r in got)
    want = Counter((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if h == big and i != 2 else "response", 2 if h == big and i != 2 else None) for i, _, h in rows)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_revisits_name_a_record(llm):
    rows = [(i, "u", "payload " * (200 + i % 3)) for i in range(30)] + [(31, "u", "small"), (32, "u", "small"), (None, "u", "payload " * 200)]
    pages = llm.createDataFrame(rows, "page_id long, url string, html string")
    heads = [r["warc_header"] for r in warc.write_archive(warc.plan_records(pages), date="2020-01-02T03:04:05Z").where("chunk = 0").collect()]
    fields = [dict(line.split(": ", 1) for line in h.strip().split("\r\n")[1:]) for h in heads]
    own = {f["WARC-Record-ID"]: f for f in fields}
    assert len(own) == len(rows) and all(f["WARC-Date"] == "2020-01-02T03:04:05Z" for f in fields)
    revisits = [f for f in fields if f["WARC-Type"] == "revisit"]
    assert len(revisits) == 28
    for f in revisits:
        target = own[f["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response" and target["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
