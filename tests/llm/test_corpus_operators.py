"""Filter audit, conversation trie and web archives against brute force on small tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from eventlake.llm import filter_audit, prefix_trie, warc
from eventlake.session import fresh_dir, setting

WORDS = "the of and to in red blue house river stone cloud idea paper green light".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ------------------------------------------------------------------------- filter audit


def audited(docs, labels):
    """(part, order, step) to counts, filter by filter over all rows."""
    fails = []
    for doc_id, text, source in docs:
        t, w = text or "", words(text or "")
        earlier = [i for i, x, _ in docs if (x or "") == t and i is not None and doc_id is not None and i < doc_id]
        good = any(q == 1 for i, q, _ in labels if i is not None and i == doc_id)
        toxic = any(x == 1 for i, _, x in labels if i is not None and i == doc_id)
        found = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": bool(earlier),
        }
        fails.append((source or "", {f for f, x in found.items() if x}, good, toxic))
    out, shapley = {}, {}
    for part in {p for p, *_ in fails}:
        rows = [r for r in fails if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f in r[1] for r in rows) - len(gone),
                    sum(r[1] == {f} for r in rows),
                    sum(r[2] for r in gone),
                    sum(r[3] for r in gone),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got_audit(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in df.collect()}


def audit_rows(n=300):
    r = random.Random(4)
    texts = [None, "", " \t\n", "A" * 60, "é" * 300, "x|y", "a\x0bb\x85c " * 120]
    for _ in range(n):
        text = " ".join(r.choices(WORDS[: r.choice([2, 15])] + [str(i) for i in range(r.choice([1, 400]))], k=r.randint(1, 400)))
        texts.append(text.title() if r.random() < 0.3 else text + r.choice(["", "", " #"]))
    docs = [(i, t, r.choice(["a", "b", None, ""])) for i, t in enumerate(texts)]
    docs += [(1000 + i, t, "a") for i, t in enumerate(texts[:80])]
    docs += [docs[3], docs[3], (5, "x|y again", "b"), (None, texts[9], "a"), (None, None, None), (2**60 + 1, texts[10], "c")]
    r.shuffle(docs)
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 0, 0), (4, 1, 1), (None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("size", [4, 1024])
def test_audit_equals_filters_applied_in_every_order(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "RANGE", size)
    docs, labels = audit_rows()
    table = spark.createDataFrame([(*d, 0, "x", 1.5) for d in docs], "doc_id long, text string, source string, row int, part string, A double")
    marks = spark.createDataFrame([(*m, 1) for m in labels], "doc_id long, quality int, toxic int, first int")
    if size == 4:  # the workers import the module anew, with its own range
        lists = filter_audit.postings(table, marks).collect()
        assert max(len(r.A) for r in lists) <= 4 and sum(r.documents for r in lists) == len(docs)
        return
    assert got_audit(filter_audit.audit(table, marks)) == audited(docs, labels)


def test_audit_of_an_empty_table_has_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(7, None, None)], docs.schema)
    got = got_audit(filter_audit.audit(one, labels))
    assert len(got) == 600 and got == audited([(7, None, None)], [])


def test_galloping_finds_what_sorting_finds():
    r = np.random.default_rng(1)
    for n, m in [(0, 5), (5, 0), (1, 1), (1000, 3), (3, 1000), (500, 500), (2000, 900)]:
        a, b = (np.unique(r.integers(0, 1500, k)) for k in (n, m))
        at = filter_audit.gallop(a, b)
        assert at.tolist() == np.searchsorted(a, b).tolist()
        assert filter_audit.found(a, b, at).tolist() == np.isin(b, a).tolist()
    lists = [np.unique(r.integers(0, 200, k)) for k in (90, 0, 200, 7, 40)]
    seen = 0
    for f, before, new in filter_audit.differences(lists):
        others = set().union(*[lists[i].tolist() for i in range(5) if before >> i & 1])
        assert set(new.tolist()) == set(lists[f].tolist()) - others
        seen += 1
    assert seen == 80


# ------------------------------------------------------------------------------- trie


def trie_of(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn, role or "", text or ""))

    def order(t):
        content = f"{len(t[1])}:{t[1]}:{t[2]}"
        return (t[0] is not None, t[0] or 0, hashlib.sha256(content.encode()).digest())

    own = {c: [t[1:] for t in sorted(ts, key=order)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(family, [])[:h] + ts[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        saved = sum((len(members[n]) - 1) * len(words(n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if paths[c] == node)
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children),
            sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def conversation_rows():
    r = random.Random(9)
    rows = []
    for c in [*range(0, 130), -3, -25, 2**60 + 1, 5_000_001, 7_000_003]:
        if c in (20, 60):
            continue  # families without their first conversation
        for turn in range(r.randint(1, 6)):
            rows.append((c, turn, r.choice(["user", "assistant"]), r.choice(["hi there", "yes", "", "a b\tc d"])))
    rows += [(c, t, "user", f"turn {t if c < 404 or t < 30 else -t}") for c in (401, 402, 404) for t in range(40 + c % 3)]
    rows += [(200 + i, t, "user", "same words each time") for i in range(30) for t in range(3)]
    rows += [(301, None, None, None), (301, None, "user", "b"), (301, 2, "user", None), (301, 2, "x", "y"), rows[5], rows[5]]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (340, 3, "", "late"), (341, 0, "r:x", "y"), (342, 0, "r", "x:y")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("thin", [0, 70, 10**6])
def test_trie_equals_grouping_of_all_prefixes(spark, monkeypatch, thin):
    monkeypatch.setattr(prefix_trie, "THIN", thin)
    rows = conversation_rows()
    table = spark.createDataFrame([(*x, 1, "x") for x in rows], "conv_id long, turn long, role string, text string, depth int, k1 string")
    got = prefix_trie.trie(table).collect()
    assert sorted((tuple(r) for r in got), key=str) == trie_of(rows)


def test_trie_of_an_empty_table_has_no_nodes(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], schema)).collect() == []


def test_pieces_of_ids_give_the_digest_of_all_ids(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rows = [(1, 5, 6, i) for i in range(11)] + [(1, 5, 7, 3), (2, 0, 0, 9), (2, 0, 0, 10)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], [*prefix_trie.KEY, "conv_id"])
        for part in (rows[:2], rows[2:9], rows[9:])
    ]
    got = {}
    for batch in prefix_trie.digested(prefix_trie.joined_ids(iter(batches))):
        got |= {tuple(r.values())[:3]: r["ends_sha256"] for r in batch.to_pylist()}
    want = {k: ",".join(str(r[3]) for r in rows if r[:3] == k) for k in {r[:3] for r in rows}}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


# -------------------------------------------------------------------------------- WARC

INNER = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: 77\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def page_rows():
    r = random.Random(3)
    plain = ["<p>" + " ".join(r.choices(WORDS, k=r.randint(1, 90))) + "</p>" for _ in range(60)]
    tricky = [
        None,
        "",
        "WARC/1.1\r\n",
        "x" * 150 + "WARC/1.1\r\nContent-Length: 7\r\n\r\n",
        "a" + INNER * 5 + "b",
        INNER + "\r\n\r\n",
        INNER[:-4],
        "WARC/1.1\r\n" * 40,
        "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n" + "é" * 200,
        "WARC/1.1\r\nContent-Length: -4\r\n\r\n\r\n\r\n",
        "ü" * 50,
        "z" * 99,
        "z" * 100,
        "\r\n\r\n" * 30,
        "long " * 2_000,
    ]
    texts = plain + tricky
    rows = [(i, f"http://a.example/{i}", t) for i, t in enumerate(texts)]
    rows += [(500 + i, None, t) for i, t in enumerate(tricky * 2)]
    rows += [(600, "http://x\r\nX-Page-Id: 9\r\n", plain[0]), (601, "", plain[1]), rows[2], (None, "u", plain[3]), (None, "u", "q" * 120), (None, "v", "q" * 120)]
    rows += [(-(2**62) - 1, "u", "n" * 300), (2**60 + 1, "u", "n" * 300)]
    r.shuffle(rows)
    return rows


def archived(rows):
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, _, t in rows:
        data = (t or "").encode()
        own = len(data) < 100 or first.get(t or "") in (None, i)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if own else "revisit", None if own else first[t or ""]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("codec", "block"), [("none", "1500"), ("gzip", "128m")])
def test_archives_give_back_every_page(spark, codec, block):
    rows = page_rows()
    table = spark.createDataFrame([(*x, "d", 1) for x in rows], "page_id long, url string, html string, digest string, payload int")
    folder = fresh_dir(spark, "warc-test")
    warc.write(table.coalesce(2), folder, codec)
    with setting(spark, "spark.sql.files.maxPartitionBytes", block), setting(spark, "spark.sql.files.openCostInBytes", "0"):
        got = warc.resolved(warc.read(spark, folder)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == archived(rows)
    by_id = {r.page_id: r.url for r in got}
    assert by_id[3] == "http://a.example/3" and by_id[500] is None
    assert by_id[600] == "http://x%0D%0AX-Page-Id: 9%0D%0A"


def test_a_revisit_has_no_payload_of_its_own(spark):
    table = spark.createDataFrame([(1, "u", "copy " * 40), (2, "u", "copy " * 40)], "page_id long, url string, html string")
    folder = fresh_dir(spark, "warc-test")
    warc.write(table, folder)
    text = "".join(r.value for r in spark.read.text(folder, wholetext=True).collect())
    assert text.count("copy ") == 40 and text.count("WARC-Type: revisit") == 1


def test_empty_tables_and_damaged_archives(spark):
    schema = "page_id long, url string, html string"
    assert warc.archive(spark.createDataFrame([], schema)).collect() == []
    folder = fresh_dir(spark, "warc-test")
    warc.write(spark.createDataFrame([(1, "u", "text")], schema), folder)
    spark.createDataFrame([(INNER[:-6],)], "value string").write.mode("append").text(folder, lineSep="!")
    with pytest.raises(warc.ArchiveError, match="no chain of records"):
        warc.read(spark, folder)
    junk = fresh_dir(spark, "warc-test")
    spark.createDataFrame([("junk" + INNER,)], "value string").write.text(junk, lineSep="!")
    with pytest.raises(warc.ArchiveError):
        warc.read(spark, junk)
