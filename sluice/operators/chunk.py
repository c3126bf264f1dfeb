"""Packing paragraphs into chunks of a token budget, as a fold over the array of paragraphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import estimate_tokens, split_paragraphs, tail_by_tokens

CHUNK = "struct<index:int,text:string,token_estimate:int,is_lead:boolean>"


def chunk_text(c: Column, budget: int = 3500, overlap: int = 200, lead: bool = True, separator: str = "\n\n") -> Column:
    """Chunks of a text: array of (index, text, token_estimate, is_lead).

    The first paragraph leads every chunk and is not part of the body. A paragraph
    that would overflow a chunk ends it first; the next begins with the end of the
    whole chunk before. A paragraph longer than the budget is never cut.
    """
    paragraphs = split_paragraphs(c, separator)

    def of(ps: Column) -> Column:
        head = F.get(ps, F.lit(0))
        room = F.greatest(F.lit(budget) - estimate_tokens(head), F.lit(500)) if lead else F.lit(max(budget, 500))
        zero = F.struct(
            F.array().cast(f"array<{CHUNK}>").alias("done"), F.array().cast("array<string>").alias("body"), F.lit(0).alias("tokens")
        )

        def closed(acc: Column) -> Column:
            body = F.array_join(acc["body"], "\n\n")
            text = F.concat(head, F.lit("\n\n"), body) if lead else body
            n = F.size(acc["done"])
            chunk = F.struct(n.alias("index"), text.alias("text"), estimate_tokens(text).alias("token_estimate"), (n == 0).alias("is_lead"))
            return F.array_append(acc["done"], chunk.cast(CHUNK))

        def step(acc: Column, p: Column) -> Column:
            n = estimate_tokens(p)
            over = (acc["tokens"] + n > room) & (F.size(acc["body"]) > 0)
            done = F.when(over, closed(acc)).otherwise(acc["done"])

            def start(d: Column) -> Column:
                tail = tail_by_tokens(F.element_at(d, -1)["text"], overlap) if overlap > 0 else F.lit("")
                seeded = over & (tail != "") if overlap > 0 else F.lit(False)
                body = F.when(seeded, F.array(tail)).when(over, F.array().cast("array<string>")).otherwise(acc["body"])
                tokens = F.when(seeded, estimate_tokens(tail)).when(over, F.lit(0)).otherwise(acc["tokens"])
                return F.struct(d.alias("done"), F.array_append(body, p).alias("body"), (tokens + n).alias("tokens"))

            return F.get(F.transform(F.array(done), start), F.lit(0))

        rest = F.slice(ps, 2, F.greatest(F.size(ps) - 1, F.lit(0))) if lead else ps
        packed = F.aggregate(rest, zero, step, lambda a: F.when(F.size(a["body"]) > 0, closed(a)).otherwise(a["done"]))
        alone = F.array(F.struct(F.lit(0).alias("index"), head.alias("text"), estimate_tokens(head).alias("token_estimate"), F.lit(True).alias("is_lead")).cast(CHUNK))
        return F.when(F.size(ps) == 0, F.array().cast(f"array<{CHUNK}>")).when(F.size(ps) == 1, alone if lead else packed).otherwise(packed)

    return F.get(F.transform(F.array(paragraphs), of), F.lit(0))


def chunk_shrunk(c: Column, budget: int, overlap: int, separator: str = "\n\n") -> Column:
    """The chunks for a receiver that refused the size: half the budget, 500 at least, and an overlap of a quarter of it at most."""
    half = max(budget // 2, 500)
    return chunk_text(c, half, min(overlap, half // 4), separator=separator)
