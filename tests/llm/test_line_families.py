"""Which lines recur: copies, short lines, pages of mostly shared lines, variable fields."""

from foldframe.llm import linetemplates


def own(i, j=0):
    return f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + j)} goes its own way here"


def left(spark, docs):
    """Text by doc_id after the recurring lines are dropped."""
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    return {r.doc_id: r.text for r in linetemplates.drop_recurring(table).collect()}


def test_a_page_of_many_copies_keeps_no_footer_in_the_others(spark):
    footer = "Brought to you by the people of the valley"
    docs = {i: f"{own(i)}\n{footer}" for i in range(40)} | {i: f"{own(50)}\n{footer}" for i in range(100, 400)}
    assert left(spark, docs) == {i: t.split("\n")[0] for i, t in docs.items()}


def test_short_lines_that_recur_are_dropped(spark):
    block = "All rights reserved.\nRead more\nMenu"
    docs = {i: f"{own(i)}\n{block}\n\n \nonly{chr(97 + i)}" for i in range(20)} | {30: "Menus\nMenu", 31: " Menu\n"}
    want = {i: f"{own(i)}\n\n \nonly{chr(97 + i)}" for i in range(20)} | {30: "Menus", 31: ""}
    assert left(spark, docs) == want


def test_pages_of_mostly_shared_lines_lose_them(spark):
    block = "\n".join(f"shared block {chr(97 + j)} of the site menu" for j in range(20))
    docs = {i: f"{block}\n{own(i)}" for i in range(12)}
    docs |= {i: f"{block}\n{own(0, 1)}" for i in range(20, 30)}  # copies of one more page
    assert left(spark, docs) == {i: t.split("\n")[-1] for i, t in docs.items()}
    few = {i: t for i, t in docs.items() if i < 6 or i >= 20}  # 7 different pages, 10 of them copies
    assert left(spark, few) == few


def test_lines_of_many_digit_fields_are_dropped_and_numbers_stay(spark):
    fields = lambda i: [f"Last updated 2024-01-{i + 1:02} 12:{i + 10}", f"Posted {i + 1} May 2024", f"Page {i} of {i + 9}", "Tel 0800 123 456", "0800 123 456"]
    numbers = lambda i: [f"{i} {i * 7} {i * 9}", f"| {i} | {i * 3} | {i * 5} |", f"{1900 + i}"]
    docs = {i: "\n".join([own(i), *fields(i), *numbers(i)]) for i in range(20)}
    assert left(spark, docs) == {i: "\n".join([own(i), *numbers(i)]) for i in docs}
