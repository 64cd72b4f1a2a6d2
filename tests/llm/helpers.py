"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing column names."""

import random
import zlib

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, ids string, fp string, length string, "
          "size string, cell string, row string, h string, score string, sequence_id string, toxic string, quality string")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeéñor") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward() -> list[tuple]:
    texts = [(1, words(1, 60)), (2, None), (3, ""), (4, words(4, 6000)), (5, words(5, 40)), (5, words(5, 40)),
             (6, words(5, 40)), (7, " \n\t "), (None, words(8, 30)), (None, None), (9, "one two"),
             (10, "x" * 20000), (11, words(11, 50) + "\n" + words(11, 50)), (12, "a <|endoftext|> b"),
             (13, "mail a.b@c.example.org or +1 (555) 010-9999 at 10.0.0.255, card 4111 1111 1111 1111 ok")]
    return [(i, t, None, "s", None, *["clash"] * 11) for i, t in texts]


def docs(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def plain(spark, texts: dict):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def remainder(i, n: int) -> int:
    return zlib.crc32(str(i).encode()) % n
