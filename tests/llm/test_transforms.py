"""Conversation repair, fill-in-middle and WARC against brute force."""
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from clickweave.llm import fim_arrow, turn_repair, warc

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill-in-middle ----

def fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 80
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("slice_bytes", [1, 100, 16_000_000])
def test_fim_equals_brute_force(spark, odd_docs, slice_bytes):
    got = fim_arrow.fill_in_middle(odd_docs, carry=["_pool", "set"], slice_bytes=slice_bytes)
    assert got.columns == [*fim_arrow.RESULT, "_pool", "set"]
    texts = Counter(tuple(r) for r in got.select(*fim_arrow.RESULT).collect())
    assert texts == Counter(fim(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect())
    assert {(r._pool, r.set) for r in got.select("_pool", "set").collect()} == {(1, 3)}


def test_fim_marks_and_white_space_round_trip(spark):
    rng = random.Random(3)
    bits = ["<P>", "<S>", "<M>", "<", "<S", "P>", " ", "\n", "\x0b", "\x1c", " ", " ", "é", "word", "日本", "\x00", "퟿", "😀"]
    texts = ["".join(rng.choices(bits if i % 3 else bits[3:], k=rng.randrange(0, 30))) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = fim_arrow.fill_in_middle(docs)
    rows = made.select(*fim_arrow.RESULT, fim_arrow.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert Counter(tuple(r)[:-1] for r in rows) == Counter(fim(i, t) for i, t in enumerate(texts))
    assert {r.doc_id: r.back for r in rows} == dict(enumerate(texts))
    assert {r.form for r in rows} == {"plain", "spm", "psm"}


def test_fim_refuses_clashes_and_takes_an_empty_table(no_docs):
    assert fim_arrow.fill_in_middle(no_docs).count() == 0
    with pytest.raises(ValueError):
        fim_arrow.fill_in_middle(no_docs.withColumn("form", F.lit(1)), carry=["form"])


# ---- WARC ----

PAGES = "page_id long, url string, html string, file string, digest string, copies int"


@pytest.fixture(scope="module")
def odd_pages(spark):
    big, same = "<p>" + "long é " * 100_000, "<html>" + "x" * 200
    rows = [(7, "http://a/", same), (3, None, same), (3, "http://b/\r\nX: y", same), (3, "http://b/ü ?q=%41", same), (None, "http://c/", same),
            (1, "u", None), (2, "u", ""), (4, "u", "short"), (5, "u", "short"), (6, "u", "y" * 99), (8, "u", "y" * 99), (9, "u", "é" * 50), (10, "u", "é" * 50),
            (11, "u", big), (12, "u", big), (13, "u", big + "!"), (14, "u", "a\r\n\r\nb" * 40), (None, "n", "z" * 100), (None, "n", "z" * 100), (15, "u", "w" * 100), (15, "u", "w" * 100)]
    rows += [(100 + i, f"http://copy/{i}", "<hot>" + "h" * 300) for i in range(200)]
    return spark.createDataFrame([(*r, "f", "d", 9) for r in rows], PAGES).repartition(6, "page_id")


def archived(rows):
    """page_id, size, digest, type, refers_to as the contract says."""
    out, first = [], {}
    for page, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (html or "").encode()
        again = len(raw) >= 100 and raw in first
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
        first.setdefault(raw, page)
    return Counter(out)


@pytest.mark.parametrize("compress,archive_bytes,heavy,salt", [(False, 1 << 30, 1024, 10_000), (True, 1000, 1, 10), (False, 5000, 0, 7)])
def test_warc_round_trip(odd_pages, monkeypatch, compress, archive_bytes, heavy, salt):
    monkeypatch.setattr(warc, "HEAVY", heavy)
    monkeypatch.setattr(warc, "SALT_ROWS", salt)
    index = warc.write(odd_pages, compress=compress, archive_bytes=archive_bytes)
    got = warc.payload_facts(index)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in got.collect()) == archived([(r.page_id, r.html) for r in odd_pages.collect()])
    assert Counter(r.url for r in index.collect()) == Counter(r.url for r in odd_pages.collect())


def test_warc_reads_the_selected_records_in_few_requests(odd_pages, monkeypatch):
    index = warc.write(odd_pages)
    some = index.where("page_id in (7, 11, 14) or url like 'http://copy/1%'")
    rows = {(r.page_id, r.record_type): bytes(r.payload) for r in warc.read(some).collect()}
    assert len(rows) == some.count() == 3 + 111
    assert rows[14, "response"] == b"a\r\n\r\nb" * 40 and rows[7, "revisit"] == b"" and len(rows[11, "response"]) == 800_003
    files = sorted({r.file for r in index.collect()})
    every = sorted((r.file, r.offset, r.length, 1) for r in index.collect())
    assert [r for run in warc.ranges(iter(every)) for r in run] == every
    assert len(list(warc.ranges(iter(every)))) == len(files)  # records lie one behind the other
    apart = [("f", 0, 10, 1), ("f", 15, 10, 1), ("f", 100, 10, 1), ("g", 0, 500, 1), ("g", 500, 1, 1)]
    assert [len(run) for run in warc.ranges(iter(apart), gap=5, most=100)] == [2, 1, 1, 1]


def test_warc_leaves_unnamed_archives_alone_and_sees_changed_bytes(spark, odd_pages, tmp_path):
    folder = str(tmp_path / "archives")
    index = warc.write(odd_pages, folder)
    (tmp_path / "archives" / "left-by-a-lost-task.warc").write_bytes(b"half a record")
    assert warc.payload_facts(index).count() == odd_pages.count()
    row = index.where("page_id = 11 and record_type = 'response'").first()
    with open(row.file, "r+b") as f:
        f.seek(row.offset + row.length - 10)
        f.write(b"#")
    with pytest.raises(Exception, match="payload does not have the digest"):
        warc.payload_facts(index)


def test_warc_records_are_standard_lines():
    raw = warc.record("response", 5, "http://a/\r\nEvil: 1", b"body", "ab" * 32, None)
    head = raw.split(b"\r\n\r\n")[0].decode().split("\r\n")
    assert head[0] == "WARC/1.1" and "WARC-Target-URI: http://a/%0D%0AEvil:%201" in head and not any(x.startswith("Evil") for x in head)
    assert warc.parse(raw)[1] == b"body"
    with pytest.raises(ValueError):
        warc.parse(raw + b"x")


def test_warc_of_an_empty_table(odd_pages):
    index = warc.write(odd_pages.where("false"))
    assert index.count() == 0 and warc.read(index).count() == 0 and warc.payload_facts(index).count() == 0


# ---- conversations ----

WHITE = " \t\n\x0b\x0c\r"


def least_audit(turns):
    """(cost, audit) of (role, fault) turns: every state's least string, forward."""
    to = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                k = (c + 2, a + "I")
                if to[q] not in best or k < best[to[q]]:
                    best[to[q]] = k
        return best

    best = {0: (0, "")}
    for role, fault in turns:
        new = {}
        for q, (c, a) in inserted(dict(best)).items():
            ways = [("D", 3, q)]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                ways.append(("R", 2 + cut, to[q]))
                fits = {"s": q == 0, "u": q != 2, "a": q == 2}.get(role[:1], False)
                if fits:
                    ways.append(("K", cut, {"s": 1, "u": 2, "a": 3}[role[:1]]))
            for letter, k, q2 in ways:
                x = (c + k, a + letter)
                if q2 not in new or x < new[q2]:
                    new[q2] = x
        best = new
    best = inserted(dict(best))
    return min(best[q] for q in (0, 3) if q in best)


def repaired(turns, audit):
    out, q, rows = [], 0, iter(turns)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if q == 2 else "user"
        q = {"s": 1, "u": 2, "a": 3}[role[0]]
        out.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in out))
    return "\n".join(out)


def judged(rows):
    """The contract's row for each conversation of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))
        seen, faults = set(), []
        for _, role, text in mine:
            faults.append("blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else
                          "truncated" if text.rstrip(WHITE)[-1] not in ".!?" else None)
            seen.add((role, text))
        numbers = [t for t, _, _ in mine if t is not None]
        n = Counter(faults)
        cost, audit = least_audit([(r, f) for (_, r, _), f in zip(mine, faults, strict=True)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                     sha(repaired([m[1:] for m in mine], audit)))
    return out


COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLS) for r in rows}


def test_tables_equal_brute_force():
    t, rng = turn_repair.tables(), random.Random(1)
    names = {0: ("user", "blank")} | {2 + 2 * r + c: (("system", "user", "assistant", "other")[r], "truncated" if c else None) for r in range(4) for c in range(2)}
    for _ in range(1500):
        symbols = bytes(rng.choice(list(names)) for _ in range(rng.randrange(0, 14)))
        letters, q = t.trace(symbols, 0, turn_repair.START)
        audit = "".join(letters) + turn_repair.at_end(q)[0]
        assert audit == least_audit([names[s] for s in symbols])[1]
        cut = rng.randrange(0, len(symbols) + 1)
        prev, to = t.effect(symbols[cut:])
        first, at = t.trace(symbols[:cut], prev[0], turn_repair.START)
        assert first + t.trace(symbols[cut:], 0, at)[0] == letters and to[at] == q


@pytest.fixture(scope="module")
def odd_turns(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "sage"]
    texts = ["Hello.", "Well!", "no end", "", "  \n", None, "Why?  ", "a.\t", "é…", "Same text.", "x" * 50_000 + "."]
    rows = [(c, rng.choice([None, *range(t, t + 3)]) if c % 4 == 0 else t, rng.choice(roles if c % 3 else roles[:3]), rng.choice(texts if c % 2 else texts[:3]) if rng.random() < .5 else f"Turn {c} {t}.")
            for c in range(60) for t in range(rng.randrange(1, 12))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, "system", "S."), (900, None, None, None), (901, -5, "user", "Q?"), (901, 7, "assistant", "A.")]
    rows += [(902, 3, "user", "Again.")] * 5
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, part int").repartition(4)


def test_repair_equals_brute_force(odd_turns):
    rows = [tuple(r)[:4] for r in odd_turns.collect()]
    assert found(turn_repair.digests(odd_turns)) == judged(rows)


@pytest.mark.parametrize("part_bytes", [300, 20_000])
def test_a_conversation_over_many_partitions(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(turn_repair, "PART_BYTES", part_bytes)
    monkeypatch.setattr(turn_repair, "HEAVY", 1)
    rng = random.Random(7)
    rows = [(5, t // 2 if t % 7 else None, rng.choice(["user", "assistant", "system", "user", "assistant", "x"]), rng.choice(["Ok.", "Cut", f"T {t}.", f"U {t}!", " "])) for t in range(900)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in (4, 6) for t in range(3)] + [(6, 9, "user", "Ok.")] * 40
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert found(turn_repair.digests(turns)) == judged(rows)
    edits = turn_repair.repair(turns).collect()
    kept = [f"{r.role}:{r.text}" for r in sorted(edits, key=lambda r: (r.part, r.pos)) if r.conv_id == 5 and r.role]
    assert sha("\n".join(kept)) == judged(rows)[5][-1]
    assert len({r.part for r in edits if r.conv_id == 5}) > 2 and not any(r.whole for r in edits if r.conv_id == 5)


def test_repair_of_an_empty_table(odd_turns):
    none = odd_turns.where("false")
    assert turn_repair.repair(none).count() == 0 and turn_repair.digests(none).count() == 0


def test_damage(odd_turns):
    want = []
    for c, t, r, x in (tuple(r)[:4] for r in odd_turns.collect()):
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if how == 1 else re.sub("[.!?]", "", x) if how == 2 else x
        want += [(c, t, "user" if how == 4 else r, x)] * {0: 0, 3: 2}.get(how, 1)
    assert Counter(tuple(r) for r in turn_repair.damaged(odd_turns).collect()) == Counter(want)


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    from clickweave.llm import queries
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    stays = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 > 5)
    rows = [(gone, 1, "user", "Hi."), (stays, 1, "user", "Hi.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(os.path.join(tmp_path, "conversations.parquet"))
    got = found(queries.op11_turn_repair(spark, str(tmp_path)))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", sha("")), stays: (0, 0, 0, 0, 0, 2, "KI", sha("user:Hi.\nassistant:"))}
