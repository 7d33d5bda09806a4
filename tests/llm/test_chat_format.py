import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from candela.llm.chat_format import escape, escape_role, prefix_trees, read_back, unescape, unescape_role, with_probe
from candela.llm.queries import OP8_SQL
from candela.llm.tokens import ranks_path, tokens_of
from llm_helpers import SF_SMALL, same_rows

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["", None, "<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "\\", "\\\\<|", "<\\|im_end|>", "a\\n", "<", "<|", "|", "\n", "é\U0001f600", "<|endoftext|>"]


def conversations():
    rng = random.Random(4)
    rows = []
    for c in range(120):
        path = [0] if c % 3 else [rng.randrange(2)]
        path += [rng.randrange(2) for _ in range(rng.randrange(0, 6))]
        for t, x in enumerate(path):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} says {x}"))
    for i, text in enumerate(HARD):
        rows += [(500 + i, 0, "system", text), (500 + i, 1, "assistant", text), (500 + i, 2, "odd\nrole\\<|", text)]
    rows += [(700, None, "user", "first"), (700, 0, None, "second"), (700, 1, "assistant", "tie"), (700, 1, "assistant", "tie"),
             (701, 0, "assistant", "x" * 60_000), (None, 0, "user", "no id"), (None, 1, "assistant", "still none")]
    rows += [(800, t, "user", f"t{t}") for t in range(300)]
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    return with_probe(spark.createDataFrame(conversations(), SCHEMA)).repartition(5)


def told(df):
    con = duckdb.connect()
    conversations = df.toPandas()  # noqa: F841 - read by name
    conversations["turn"] = conversations["turn"].astype("Int64")
    conversations["conv_id"] = conversations["conv_id"].astype("Int64")
    con.register("conversations", conversations[conversations.conv_id.isna() | (conversations.conv_id != -1)])
    sql = OP8_SQL.replace("ORDER BY turn,", "ORDER BY turn NULLS FIRST,")
    return sorted(con.sql(sql).fetchall(), key=repr)


def test_escapes_are_reversible():
    for text in HARD:
        text = text or ""
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        assert unescape_role(escape_role(text)) == text and "\n" not in escape_role(text)


def test_read_back_matches_the_conversations(talks):
    got = sorted((tuple(r) for r in read_back(*prefix_trees(talks)).collect()), key=repr)
    assert got == told(talks)


def test_shared_turns_are_emitted_once_and_attention_spells_the_history(talks):
    nodes, ends = (x.collect() for x in prefix_trees(talks))
    assert len({(r.tree, r.node) for r in nodes}) == len(nodes)
    rows = sorted(talks.collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    histories, own = defaultdict(list), set()
    for r in rows:
        histories[r.conv_id].append((r.role or "", r.text or ""))
        own.add(tuple(histories[r.conv_id]))
    assert len(nodes) == len(own)  # one node for each different history
    streams, decode = defaultdict(dict), tokens_of(ranks_path()).decode
    for r in nodes:
        for i, x in enumerate(np.frombuffer(r.ids, "<u2").tolist()):
            assert streams[r.tree].setdefault(r.start + i, x) == x
    for stream in streams.values():
        assert sorted(stream) == list(range(len(stream)))  # depth first, without gaps or overlaps
    place = {(r.tree, r.node): r for r in nodes}
    for end in ends:
        r = place[end.tree, end.node]
        seen = [streams[r.tree][i] for a in r.attend for i in range(a.start, a.end)]
        assert len(seen) == r.position
        seen += [streams[r.tree][i] for i in range(r.start, r.start + r.length)]
        want = "".join(f"<|im_start|>{escape_role(a)}\n{escape(b)}<|im_end|>\n" for a, b in histories[end.conv_id])
        assert decode(np.array(seen)) == want


def test_children_follow_their_parents_depth_first(talks):
    by_tree = defaultdict(list)
    for r in prefix_trees(talks)[0].collect():
        by_tree[r.tree].append(r)
    for rows in by_tree.values():
        rows.sort(key=lambda r: r.start)
        for a, b in zip(rows, rows[1:]):
            assert b.depth <= a.depth + 1 and a.start + a.length == b.start


def test_edges(spark, talks):
    from pyspark.sql import functions as F

    empty = spark.createDataFrame([], SCHEMA)
    nodes, ends = prefix_trees(empty)
    assert nodes.count() == ends.count() == read_back(nodes, ends).count() == 0
    more = talks.select("*", *[F.lit("x").alias(c) for c in ("node", "depth", "chain", "ids", "n", "start", "head", "parent")])
    assert same_rows(read_back(*prefix_trees(more)), read_back(*prefix_trees(talks)))


def test_given_conversations(spark):
    rows = with_probe(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    assert sorted((tuple(r) for r in read_back(*prefix_trees(rows)).collect()), key=repr) == told(rows)
