from oracle import compare, duck
from pagesift.llm import chat


def test_chat_oracle(spark):
    con = duck("/root/testdata/sf0.001")
    n, problems = compare(chat.op5_chat(spark, "/root/testdata/sf0.001"), con, chat.ORACLES["op5_chat"])
    assert n and not problems, problems


def test_oracle_on_repeated_passages_and_excerpts(spark, tmp_path):
    """Turns that repeat, turns that hold quotes of their own (whole, of some lines, of none)."""
    turns = [["Yes", "What now", "Yes", "Done", "Yes"], ["Thanks"] * 6,
             ["one\ntwo\nthree", "> two\nsome lines", "other", "> one\n> three\nboth", "> gone\nx", "two\none", "> two\n> one\nlater", ">> other\nnested"]]
    rows = [(c, t, "u" if t % 2 else "a", text) for c, some in enumerate(turns) for t, text in enumerate(some)]
    where = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(where)
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{where}/*.parquet')")
    n, problems = compare(chat.op5_chat(spark, str(tmp_path)), con, chat.ORACLES["op5_chat"])
    assert n == len(rows) and not problems, problems


def test_threads_are_rebuilt(spark):
    conv = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.format_chats(chat.quoted_threads(conv)).collect()
    own = {(r.conv_id, r.turn): " ".join(r.text.split()) for r in conv.collect()}
    assert len(got) == len(own)
    assert all(" ".join(r.text.split()) == own[r.conv_id, r.turn] for r in got)
    assert sum(r.depth == r.turn - min(t for c, t in own if c == r.conv_id) for r in got) / len(got) > 0.99


def test_odd_messages(spark):
    rows = [(1, 0, "u", "Hello there"), (1, 1, "a", "> hello   THERE\nHi!"), (1, 2, "u", ">> Hello there\n> Hi!\n\nBye"),
            (1, 3, "a", "> no such line\nWhat?"), (1, 4, "u", "> Hi!\nmiddle\n> Bye\nend"), (1, 4, "u", "> Hi!\nmiddle\n> Bye\nend"),
            (1, 5, "a", None), (2, 0, None, "> Hello there\nother scope"), (None, 0, "u", "no scope"), (None, 1, "u", "> no scope\nx"),
            (3, None, "u", "no order"), (3, 1, "u", "> no order\ny")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = {(r.conv_id, r.turn): r for r in chat.format_chats(df).collect()}
    assert len(got) == len(set(rows))
    ids = {k: r.message_id for k, r in got.items()}
    parent = {k: r.parent_id for k, r in got.items()}
    assert parent[1, 1] == ids[1, 0] and parent[1, 2] == ids[1, 1] and parent[1, 4] == ids[1, 2]
    assert parent[1, 3] is None and got[1, 3].n_quotes == 1 and got[1, 3].n_linked == 0
    assert parent[2, 0] is None and parent[None, 1] == ids[None, 0] and parent[3, 1] == ids[3, None]
    assert got[1, 4].text == "middle\nend" and got[1, 4].depth == 3 and got[1, 4].conversation_id == ids[1, 0]
    assert got[1, 5].text == "" and got[1, 2].max_level == 2
    assert chat.format_chats(df.limit(0)).count() == 0


def test_latest_of_repeated_originals(spark):
    rows = [(1, 0, "u", "Yes"), (1, 1, "a", "> Yes\nGood"), (1, 2, "u", "Yes"), (1, 3, "a", "> Yes\nFine"), (1, 4, "u", "Yes"),
            (1, 4, "a", "> Yes\nSame order")] + [(2, i, "u", "Thanks" if i % 2 == 0 else "> Thanks\nn%d" % i) for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn, r.role): r for r in chat.format_chats(df).collect()}
    parent = {k: r.parent_id for k, r in got.items()}
    assert parent[1, 1, "a"] == got[1, 0, "u"].message_id and parent[1, 3, "a"] == got[1, 2, "u"].message_id
    assert parent[1, 4, "a"] == got[1, 2, "u"].message_id and got[1, 3, "a"].conversation_id == got[1, 2, "u"].message_id
    assert all(parent[2, i, "u"] == got[2, i - 1, "u"].message_id for i in range(1, 400, 2))       # over several ranges


def test_excerpts_are_linked(spark):
    rows = [(1, 0, "u", "First line\nSecond line\n\nThird line\nFourth line"), (1, 1, "a", "Second line\nOther"),
            (1, 2, "u", "> third  LINE\n> Fourth line\nOne paragraph"), (1, 3, "u", "> First line\n> Fourth line\nSome lines"),
            (1, 4, "u", "> Second line\nLatest holder"), (1, 5, "u", "> First line\n> Other\nOf two messages"),
            (1, 6, "u", ">> Third line\n> One paragraph\nNested"), (2, 0, "u", "> First line\nOther scope"),
            (None, 0, "u", "p\nq"), (None, 1, "u", "> q\nNull scope"), (3, None, "u", "p\nq"), (3, 0, "u", "> p\nNull order")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in chat.format_chats(df).collect()}
    parent, ids = {k: r.parent_id for k, r in got.items()}, {k: r.message_id for k, r in got.items()}
    assert parent[1, 2] == parent[1, 3] == ids[1, 0] and parent[1, 4] == ids[1, 1]
    assert parent[1, 5] is None and got[1, 5].n_quotes == 1 and got[1, 5].n_linked == 0 and parent[2, 0] is None
    assert parent[1, 6] == ids[1, 2] and got[1, 6].n_linked == 2 and got[1, 6].depth == 2
    assert parent[None, 1] == ids[None, 0] and parent[3, 0] == ids[3, None]
