"""Random tokens right after an equals sign, in key=value lines and addresses."""

import random
import string

from tidemark.llm.secrets import redacted, scan_secrets

RND = random.Random(6)
KEY, OTHER = ("".join(RND.choice(string.ascii_letters + string.digits) for _ in range(n)) for n in (32, 40))
NAMES = ["internationalization_settings", "configuration_manager_factory", "the_quick_brown_fox_jumps", "understanding", "characteristically"]
#: Text, and what is left of it.
TEXTS = [(f"AUTH={KEY}", "AUTH=[secret]"), (f"export AUTH={KEY}\nB=1", "export AUTH=[secret]\nB=1"),
         (f"https://h/a?sig={KEY}&n=1", "https://h/a?sig=[secret]&n=1"), (f"sig={KEY}==&n=1", "sig=[secret]&n=1"),
         (f"AUTH = {KEY}= x", "AUTH = [secret] x"), (f"a {KEY}=={OTHER}= b", "a [secret]==[secret] b"), (f"{KEY}=== x", "[secret]= x"),
         (f"password={KEY} AUTH=={OTHER}", "[secret] AUTH==[secret]"),
         (f"internationalization_settings={KEY}", "internationalization_settings=[secret]"),
         ("name=internationalization_settings x=the_quick_brown_fox_jumps=", "name=internationalization_settings x=the_quick_brown_fox_jumps="),
         ("understanding=1 AUTH=short", "understanding=1 AUTH=short")]


def test_after_equals_sign(spark):
    plain = [" ".join(RND.choices(NAMES, k=60)) for _ in range(250)]
    rows = [t for t, _ in TEXTS] + plain
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = dict(map(tuple, scan_secrets(docs).select("doc_id", redacted("text", "spans")).collect()))
    assert [got[i] for i in range(len(rows))] == [w for _, w in TEXTS] + plain
