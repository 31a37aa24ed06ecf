"""Small inputs and plain counterparts of the operators."""

import re

import xxhash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, salt string, fp string, body string"


def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, clashing extra columns."""
    long_text = "alpha beta gamma delta " * 30_000
    rows = [
        (1, "one two three four five", "en", "a", 5, "x", "y", "z", "w"),
        (2, " one  two\tthree four five\n", None, None, None, None, None, None, None),
        (3, None, "en", "a", 0, "x", "y", "z", "w"),
        (4, "", "en", None, 0, "x", "y", "z", "w"),
        (5, " \t\n\x0b\x0c\r", "de", "a", 6, "x", "y", "z", "w"),
        (6, long_text, "en", "b", None, "x", "y", "z", "w"),
        (7, long_text + "x", "en", "b", None, "x", "y", "z", "w"),
        (8, " nbsp stays é\U0001F600", "fr", "c", 1, "x", "y", "z", "w"),
        (8, " nbsp stays é\U0001F600", "fr", "c", 1, "x", "y", "z", "w"),
        (None, "no id at all", "en", "a", 1, "x", "y", "z", "w"),
        (None, "one two three four five", "en", "a", 1, "x", "y", "z", "w"),
        (10, "ONE two three four five", "en", "a", 1, "x", "y", "z", "w"),
        (-4, "one two three four five", "en", "a", 1, "x", "y", "z", "w"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def simhash(text, shingle=3):
    words = WORDS.findall((text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))))
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """Connected groups by plain search."""
    root = {}
    for node in nodes:
        if node in root:
            continue
        root[node], todo = node, [node]
        while todo:
            for other in linked(todo.pop()):
                if other not in root:
                    root[other] = root[node]
                    todo.append(other)
    return root
