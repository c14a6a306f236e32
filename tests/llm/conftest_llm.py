import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SF_DIR = "/root/testdata/sf0.001"
#: Names that the operators give to columns of their own.
CLASHING = (
    "shard string, SCORE double, predicted int, kept boolean, size long, target double, copies long, place long, "
    "bytes long, simhash long, component_id long, doc string, mix string, source_size long, id string, flag int"
)
SCHEMA = f"doc_id long, text string, lang string, source string, {CLASHING}"
FILL = ("s", 0.5, 1, True, 7, 0.1, 2, 3, 4, 5, 6, "d", "m", 8, "i", 9)
LONG = " ".join(f"word{k % 700} and more{k}" for k in range(20_000))
COPY = " ".join(f"copied{k}" for k in range(60))


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, *FILL)


EDGE_ROWS = [
    doc(1, None), doc(2, ""), doc(3, " \n\t "), doc(4, "one"), doc(5, COPY), doc(6, COPY, "b"), doc(6, COPY, "b"),
    doc(None, COPY, None), doc(None, "null id", None), doc(7, LONG, "c"), doc(8, "x " * 300, None),
    doc(9, "Ünïcode words  and \x1c marks \U0001f600 " * 20), doc(10, "a\r\nb\rc\x0bd\x0ce " * 30), doc(11, "same"), doc(11, "same"),
]


def words(text):
    return WORD.findall(text or "")
