"""A line costs few passes: what most lines do not have is told by one search, and the rules stay the same."""

from lodgegrid.llm.line_rules import OP8_SQL, judged, op8_quality_rules

from .test_lines import rows_of, sql_rows

END = "This line has enough words to count as a text, and it ends well."
PHRASE = "click here"


def test_words_lie_beside_each_other_and_only_lost_lines_are_measured(make_docs):
    plan = judged(make_docs([(1, END)])).drop("doc", "clean_text")._jdf.queryExecution().optimizedPlan().toString()
    # no slice and no boxed array per window
    assert "arrays_zip(slice(" in plan and "xxhash64(slice(" not in plan
    # words are counted for lines with counted marks alone, phrases are looked for in short lines alone
    assert plan.count(", [#*$%&|<>])") >= 2 and ", [!])" in plan and ", [|])" in plan
    assert plan.index("{0,11}+$") < plan.index("javascript")


def test_edges_of_the_searches_equal_sql(spark, make_docs, tmp_path):
    lines = [
        # 12 and 13 words with a phrase, also with wide and repeated white space
        " ".join([PHRASE, *"abcdefghij"]) + ".", " ".join([PHRASE, *"abcdefghijk"]) + ".",
        " \t" + "  \x0b ".join([PHRASE, *"abcdefghij"]) + ".\t", "\x0c" + "\t\t".join([PHRASE, *"abcdefghijk"]) + ". \r",
        "CLICK HERE.", "Click\there.", "clicK here now", "JAVASCRIPT!", "a" * 5000 + " javascript",
        # plain marks at the end, before a closing mark, inside, and none
        *(f"one two three{mark}" for mark in (".", "!", "?", ":", ";", "…", "。", ".”", '."', ".)", ",", "।", "」")),
        "one. two three", "one.two three", ".", "!", "!!", "a!", "a! b! c d", "| a |", "a | b c d e f.", "a|b.", "#", "a # b c.",
        "$5 & 6% < 7 > *", "x y.", " ", " ", "é" * 40 + ".", "Home.", "home", "", " ", "\r",
    ]
    docs = [(i, f"{END}\n{line}") for i, line in enumerate(lines)] + [(1000 + i, line) for i, line in enumerate(lines)]
    docs += [(2000, "\n".join(lines)), (2001, "\n".join(lines * 3)), (2002, None), (2003, "a b c d"), (2004, "a b c d e"),
             (2005, "a b c d e a b c d e"), (2006, "a b c d e f a b c d e f a b c d"), (2007, "w " * 9), (2008, "é é é é é é")]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(op8_quality_rules(spark, str(tmp_path))) == sql_rows(OP8_SQL, docs)
