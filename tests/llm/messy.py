"""A small document table with every awkward case, and plain-Python words."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "n long, key string, score double, bucket string, size long, position string, row_no long, value string")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows(seed: int = 5) -> list[tuple[int | None, str | None, str | None, str | None]]:
    rng = random.Random(seed)
    vocabulary = [f"wörd{k}" if k % 7 == 0 else f"word{k}" for k in range(300)]

    def prose(n: int) -> str:
        return "\n".join(" ".join(rng.choice(vocabulary) for _ in range(9)) + "." for _ in range(n // 9 + 1))

    passage = prose(60)
    line = "This line stands on very many sites."
    out: list = []
    for k in range(40):
        text = prose(rng.randrange(5, 120))
        if k % 4 == 0:
            text += "\n" + passage
        if k % 2 == 0:
            text += "\n" + line
        out.append((k, text, "en", f"site{k % 15}"))
    out += [(100 + k, out[3][1] + f" tail{k}", "en", f"site{k}") for k in range(12)]  # near copies
    out += [(200 + k, out[5][1].upper() if k % 2 else out[5][1], "de", None) for k in range(4)]  # copies but for case
    out += [(300, None, None, None), (301, "", "en", "site1"), (302, " \t\n\x0b\f\r ", "en", "site2"),
            (303, "two words", "en", "site3"), (304, "a b " * 60, "en", "site4"), (305, " ".join(["x"] * 34), "en", "site5")]
    out += [(None, "no id at all " * 12, "en", "site6"), (None, "no id at all " * 12, "en", "site6")]
    out += [(7, out[7][1], "en", "site7")]  # a repeated row
    out += [(8, "another text under a known id " * 3, "en", "site8")]
    out += [(400, " ".join(rng.choice(vocabulary) for _ in range(60_000)), "en", "site9")]  # very long
    return out


def frame(spark, own=None):
    """The rows with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, a, s, None if t is None else len(t), 1, "k", 0.5, "b", 2, "p", 3, None)
                                  for i, t, a, s in (rows() if own is None else own)], SCHEMA)


def by_id(found) -> list[tuple]:
    """Rows sorted with null first, for comparing."""
    return sorted((tuple(r) for r in found), key=lambda r: tuple((v is not None, v) for v in r))
