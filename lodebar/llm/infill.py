"""Fill-in-the-middle transformation: a text's lines become prefix, middle and suffix, put in another order between marks.

Lines are cut by a pre-tokenizer of the tokenizers library that isolates the matches of a pattern; nothing is trained. It
gives the code-point offsets of every line: their number is n, and the ends that two draws rank at cut the text. A draw is
a part of the SHA-256 of seed and id, so it depends on nothing else, whatever the tasks. Only a text and two draws go to
Python, only three numbers come back; texts are put together by SQL functions.

Defined results: a null text counts as empty; an empty one, and one that holds a mark, is plain; a null id draws as an empty
one; repeated rows come out alike. Columns named like the operator's outputs are replaced, all others pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodebar.llm.common import returned, without

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def _cuts(texts: pa.Array, first: pa.Array, second: pa.Array, pattern: str) -> pa.Array:
    """(n, prefix, middle) of each text: how many units it has, and the code points where its prefix and its middle end."""
    from tokenizers import Regex, pre_tokenizers

    cut = pre_tokenizers.Split(Regex(pattern), behavior="isolated")
    out = np.zeros((3, len(texts)), np.int64)
    for i, (text, a, b) in enumerate(zip(texts, first.to_pylist(), second.to_pylist(), strict=True)):
        ends = [0, *[end for _, (_, end) in cut.pre_tokenize_str(text.as_py())]]
        n = len(ends) - 1
        low, high = sorted((a % (n + 1), b % (n + 1)))
        out[:, i] = n, ends[low], ends[high]
    returned()
    return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "prefix", "middle"])


def draws(seed: int, id_column: str) -> list[Column]:
    """Four whole numbers below 2**32 from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, pattern: str = LINES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with n, form (plain, psm or spm), prefix_chars and middle_chars (null if plain) and output.

    ``rate`` of a hundred texts are transformed, ``spm_rate`` of a hundred of these have their suffix first.
    """

    @F.arrow_udf("n long, prefix long, middle long")
    def cuts(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        return _cuts(texts, first, second, pattern)

    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    h1, h2, h3, h4 = draws(seed, id_column)
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | text.contains(m)
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    drawn = docs.withColumn("__form", form).withColumn("__cut", cuts(text, h1, h2))
    p, m = F.col("__cut.prefix").cast("int"), F.col("__cut.middle").cast("int")
    prefix, middle, suffix = text.substr(F.lit(1), p), text.substr(p + 1, m - p), text.substr(m + 1, F.length(text))
    output = (
        F.when(F.col("__form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("__form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    cut = F.col("__form") != "plain"
    values = [F.col("__cut.n"), F.col("__form"), F.when(cut, F.col("__cut.prefix")), F.when(cut, F.col("__cut.middle") - F.col("__cut.prefix")), output]
    own = drawn.withColumn("__out", F.struct(*[v.alias(name) for v, name in zip(values, OUTPUTS, strict=True)])).drop("__form", "__cut")
    return without(own, *OUTPUTS).select("*", "__out.*").drop("__out")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. A transformed text holds each mark once: texts with marks of their own are plain."""
    part = lambda k: F.element_at(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}"), k)
    return F.when(form == "psm", F.concat(part(2), part(4), part(3))).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(output)
