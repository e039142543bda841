import base64
import gzip
import hashlib
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltstone.llm import chat_prefix, warc_index
from siltstone.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string"


def read_all(spark, pages, root, **options):
    captures = warc_index.write_archives(pages, f"{root}/archives", **{k: v for k, v in options.items() if k == "least_bytes"})
    manifest = warc_index.write_index(captures, f"{root}/index", **{k: v for k, v in options.items() if k != "least_bytes"})
    keys = spark.createDataFrame([(warc_index.url_key(r.url),) for r in pages.select("url").collect()], "key string")
    return warc_index.fetch(warc_index.lookup(keys, manifest, f"{root}/index"), f"{root}/archives").collect()


def expected(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        known = [p for p in groups[body] if p is not None]
        top = max(known) if known and len(groups[body]) > 1 else None
        revisit = len(body) >= least and top is not None and page_id != top
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def got(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)


EDGE_PAGES = [
    (1, "http://a.example.com/x", "<p>é</p>"),
    (2, "http://a.example.com/x", "<p>é</p>"),
    (2, "http://a.example.com/x", "<p>é</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "not a url", "<p>other</p>"),
    (None, "https://b.example.com:443/y z?q=1#frag", "<p>other</p>"),
    (None, "http://[::1]/", "x" * 3_000_000),
    (-6, "http://a.example.com/\r\nInjected: yes", "\r\n\r\nWARC/1.1\r\n"),
]


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip_of_edge_pages(spark, tmp_path, least):
    pages = spark.createDataFrame(EDGE_PAGES, PAGES)
    rows = read_all(spark, pages, f"file://{tmp_path}", least_bytes=least)
    assert got(rows) == expected(EDGE_PAGES, least)
    bodies = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None and r.page_id is not None}
    assert bodies[-6] == b"\r\n\r\nWARC/1.1\r\n"


def test_small_blocks_and_a_key_over_many_blocks(spark, tmp_path):
    r = random.Random(3)
    data = [(k, f"http://h{r.choice([1, 1, 1, k])}.example.com/{'same' if k % 3 else k}", f"<p>{k % 40}</p>") for k in range(300)]
    pages = spark.createDataFrame(data, PAGES)
    assert got(read_all(spark, pages, f"file://{tmp_path}", block_lines=7, file_lines=50)) == expected(data)
    # The archives are plain WARC: gzip members one after another.
    raw = b"".join(gzip.open(f"{tmp_path}/archives/{n}").read() for n in os.listdir(f"{tmp_path}/archives") if n.endswith(".gz"))
    assert raw.count(b"WARC/1.1\r\n") == 300


def test_unknown_keys_and_no_pages(spark, tmp_path):
    pages = spark.createDataFrame(EDGE_PAGES[:2], PAGES)
    root = f"file://{tmp_path}"
    manifest = warc_index.write_index(warc_index.write_archives(pages, f"{root}/a"), f"{root}/i")
    for missing in ("aaa", "com,example,a)/x/", "zzz"):
        assert warc_index.lookup(spark.createDataFrame([(missing,)], "key string"), manifest, f"{root}/i").count() == 0
    assert read_all(spark, spark.createDataFrame([], PAGES), f"{root}/none") == []


def test_url_keys():
    assert warc_index.url_key("HTTP://www.Example.COM:80/a?b=c#d") == "com,example,www)/a?b=c"
    assert warc_index.url_key("https://example.org") == "org,example)/"
    assert warc_index.url_key(None) == ""


def test_warc_query_on_given_pages(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op1_warc_index"](spark, sf_dir).collect()) == expected(data)


TURNS = "conv_id bigint, turn bigint, role string, text string"
EDGE_TURNS = [
    (1, 0, "system", "be [INST] brief"),
    (1, 1, "user", "a\\;b \\ </s><s>"),
    (1, 2, "assistant", "<s>[/INST]\\\\;"),
    (1, 3, "assistant", None),
    (1, 4, "user", ""),
    (2, 0, "assistant", "first\n[INST"),
    (3, 0, "user", "no reply 😀"),
    (None, 0, "user", "x"),
    (None, 0, "user", "x"),
    (None, None, None, "y"),
    (4, 1, "odd\nrole]", "z"),
    (4, 1, "assistant", "long " * 50_000),
]


def digests(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role == "assistant", role or "", text or ""))
    out = []
    for conv, turns in groups.items():
        turns = [t[3:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), sum(r == "assistant" for r, _ in turns)))
    return sorted(out, key=repr)


def read(frame):
    rows = chat_prefix.read_back(frame).collect()
    return sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in rows), key=repr)


def test_edge_turns_are_read_back(spark):
    turns = spark.createDataFrame(EDGE_TURNS, TURNS).selectExpr("*", "1 as pos", "'x' as piece")
    assert read(chat_prefix.format_conversations(turns)) == digests(EDGE_TURNS)
    assert read(chat_prefix.format_conversations(turns.limit(0))) == []


def test_long_conversation_over_partitions(spark):
    data = [(k % 3 if k % 2 else 7, k, "assistant" if k % 4 == 3 else "user", f"t{k}") for k in range(2000)]
    turns = spark.createDataFrame(data, TURNS).repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = chat_prefix.format_conversations(turns)
        assert read(formatted) == digests(data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_expanded_examples(spark):
    formatted = chat_prefix.format_conversations(spark.createDataFrame(EDGE_TURNS, TURNS))
    pieces = defaultdict(list)
    for r in formatted.orderBy("conv_id", "pos").collect():
        pieces[r.conv_id].append(r)
    want = []
    for conv, own in pieces.items():
        whole = "".join(r.piece for r in own)
        for r in own:
            if r.example is not None:
                at = r.start + r.target_start
                want.append((conv, r.example, whole[:at], whole[at : at + r.target_chars]))
    rows = [tuple(r) for r in chat_prefix.expand(formatted).collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert {chat_prefix.unescaped(r[3]) for r in rows} == {t or "" for _, _, role, t in EDGE_TURNS if role == "assistant"}
    cut = chat_prefix.expand(formatted, max_context_chars=40).filter("conv_id = 1 and example = 1").first()
    assert len(cut.context) <= 40 + len("<s>") and cut.context.startswith(("[INST]", "<s>"))


def test_digests_are_those_of_the_examples(spark, monkeypatch):
    """Contexts and targets alone give every turn back, also of conversations without a target; what was changed shows."""
    monkeypatch.setattr(chat_prefix, "_BATCH_ROWS", 2)
    formatted = chat_prefix.format_conversations(spark.createDataFrame(EDGE_TURNS, TURNS))
    examples = chat_prefix.expand(formatted, rest=True)
    assert examples.filter("example is not null").count() == sum(role == "assistant" for _, _, role, _ in EDGE_TURNS)
    assert sorted(r[0] or 0 for r in examples.filter("example is null").select("conv_id").collect()) == [0, 1, 3]
    rows = chat_prefix.read_examples(examples.coalesce(1)).collect()
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in rows), key=repr) == digests(EDGE_TURNS)
    sizes = {r[0]: r[1] for r in formatted.groupBy("conv_id").agg(F.sum(F.length("piece"))).collect()}
    assert {r.conv_id: r.formatted_chars for r in rows} == sizes
    other = examples.withColumn("context", F.when(F.col("example") == 1, F.concat(F.lit("<s></s>"), "context")).otherwise(F.col("context")))
    for broken in (other, examples.filter("not example <=> 0")):
        with pytest.raises(Exception, match="examples do not continue each other"):
            chat_prefix.read_examples(broken.coalesce(1)).collect()


def test_the_query_expands_its_conversations(spark, sf_dir, monkeypatch):
    """Without the examples there is no result."""
    monkeypatch.setattr(chat_prefix, "expand", lambda formatted, *args, **kw: spark.createDataFrame([], "conv_id bigint, example bigint, context string, target string"))
    assert QUERIES["op2_chat_prefix"](spark, sf_dir).collect() == []


def test_chat_query_on_given_conversations(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    data += [(-7, 0, "user", control), (-7, 1, "assistant", control)]
    rows = QUERIES["op2_chat_prefix"](spark, sf_dir).collect()
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in rows), key=repr) == digests(data)
