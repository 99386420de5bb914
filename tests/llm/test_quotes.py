from tessella.llm import quotes

ROWS = [
    (1, 0, "user", "Hello all.\n\nWhere is the key?", "x"),
    (1, 1, "user", "On Monday Ann wrote:\n> Hello all.\n>\n> Where is the key?\nOn the hook.", "x"),
    (1, 2, "user", "> > Where is the KEY?\n> On the   hook.\nThanks!", "x"),
    (1, 3, "user", "> Where is the key?\nFound another.", "x"),
    (2, 0, "user", "> On the hook.\nQuoted from elsewhere.", "x"),
    (2, 1, "user", "> never said\nUnknown.", "x"),
    (2, 2, "user", None, "x"),
    (2, 2, "user", None, "x"),
    (2, 3, "user", "> > > deep\n> > deeper\n", "x"),
    (None, None, None, "Thanks!", "x"),
    (3, 5000, "user", "late", "x"),
    (3, 10, "user", "early", "x"),
]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, depth string")


def test_links(spark):
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(table(spark)).collect()}
    assert len(got) == 11
    r = got[1, 1]
    assert r.text == "On the hook." and (r.reply_conv, r.reply_turn) == (1, 0) and (r.n_quotes, r.n_linked, r.depth) == (1, 1, 1)
    r = got[1, 2]
    assert r.text == "Thanks!" and (r.reply_conv, r.reply_turn) == (1, 1) and (r.n_quotes, r.n_linked, r.depth) == (2, 2, 2)
    assert (got[1, 3].reply_conv, got[1, 3].reply_turn) == (1, 0)  # not the turn before
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn) == (1, 1)
    r = got[2, 1]
    assert r.n_linked == 0 and (r.reply_conv, r.reply_turn) == (2, 0)
    assert got[2, 2].text == "" and got[2, 3].text == "" and got[2, 3].depth == 3 and got[2, 3].n_quotes == 2
    assert got[None, None].reply_turn is None
    assert got[3, 5000].reply_turn == 10 and got[3, 10].reply_turn is None


def test_reply_order(spark):
    rows = [(r.conv_id, r.turn) for r in quotes.link_quotes(table(spark)).collect() if r.conv_id == 1]
    assert rows == [(1, 0), (1, 1), (1, 3), (1, 2)]


def test_empty(spark):
    assert quotes.link_quotes(table(spark, [])).collect() == []


def test_levels_and_passages(spark):
    got = quotes.passages(table(spark, [(1, 1, "u", "a\n> b\n>> c\n> > c2\n\nd", "")])).orderBy("passage").collect()
    assert [(r.level, r.text) for r in got] == [(0, "a"), (1, "b"), (2, "c\nc2\n"), (0, "d")]


def test_no_python_in_the_plan(spark):
    plan = quotes.link_quotes(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_against_sql(spark, tmp_path):
    """The registered SQL on conversations full of quotes, nested, partial, across conversations and of nobody."""
    import random

    import duckdb

    from tessella.llm.queries import ORACLE_SQL

    r, rows = random.Random(8), []
    for conv in [*range(25), None]:
        said: list[str] = []
        for turn in r.sample([*range(12), None], r.randint(1, 7)):
            parts = []
            for _ in range(r.randint(0, 4)):
                source = r.choice([t for *_, t, _ in rows if t] or ["nothing"]) if r.random() < 0.4 else r.choice(said or ["nothing"])
                quote = r.choice([source, r.choice(source.split("\n")), "Never said."])
                parts.append("\n".join(r.choice(["> ", ">", " > "]) + x.upper() for x in quote.split("\n")))
                parts.append(r.choice(["Ok.", "I see\n\nwhat you mean", "", f"Word {r.randint(0, 30)}", "On Monday Bob wrote:", "  "]))
            text = r.choice(["\n", "\n\n"]).join(parts) or f"Start {r.randint(0, 9)}\nSecond line"
            said.append(text)
            rows.append((conv, turn, r.choice(["user", None]), r.choice([text, text, None]), "x"))
    rows += rows[:3]
    df = table(spark, rows)
    got = sorted((tuple(x) for x in quotes.link_quotes(df).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, depth VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
    out = con.sql(ORACLE_SQL["op3_quote_links"])
    want = sorted(out.fetchall(), key=str)
    assert out.columns == quotes.link_quotes(df).columns
    assert sum(x[6] > 0 for x in want) > 20 and sum(x[4] > 1 for x in want) > 5
    assert got == want


def test_a_message_without_a_key_owns_no_text(spark):
    said = "a text that many people say"
    rows = [(None, 1, "user", said, "x"), (1, None, "user", said, "x"), (1, 2, "user", said, "x"), (5, 1, "user", f"> {said}\n\nyes", "x")]
    got = {(r.conv_id, r.turn): (r.n_linked, r.reply_conv, r.reply_turn) for r in quotes.link_quotes(table(spark, rows)).collect()}
    assert got[5, 1] == (1, 1, 2)


def test_the_work_grows_with_the_lines_of_a_message(spark):
    import time

    def seconds(n):
        text = "\n".join(f"> line {k} of {n}" if k % 3 else f"own {k}" for k in range(n))
        df = table(spark, [(1, 0, "u", "line 1 of 60000\nsaid first", ""), (1, 1, "u", text, "")])
        began = time.time()
        got = {r.turn: r for r in quotes.link_quotes(df).collect()}
        assert got[1].n_quotes == n // 3 and got[1].n_linked == (n == 60000) and len(got[1].text.split("\n")) == n // 3
        return time.time() - began

    seconds(300)
    assert seconds(60000) < 30
