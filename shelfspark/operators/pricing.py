"""J2 book_dlp: one GBP list price per book from the first currency present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import DlpRates


def book_dlp(book_meta: DataFrame, rates: DlpRates = DlpRates()) -> DataFrame:
    """GBP if present, else USD / usd_divisor, else (euro branch) / eur_divisor.

    The literal euro branch divides the *dollar* price, which is NULL there, so it is
    always NULL; ``rates.fix_eur`` divides the euro price instead. A narrow projection:
    no shuffle, runs inside one codegen stage per file split.
    """
    gbp, usd, eur = (F.col("gbp_price_exvat_float"), F.col("usd_price_exvat_float"),
                     F.col("eur_price_exvat_float"))
    eur_branch = (eur if rates.fix_eur else usd) / F.lit(rates.eur_divisor)
    dlp = (F.when(gbp.isNotNull(), gbp)
           .when(gbp.isNull() & usd.isNotNull(), usd / F.lit(rates.usd_divisor))
           .when(gbp.isNull() & usd.isNull() & eur.isNotNull(), eur_branch))
    return book_meta.select(F.col("id").alias("book_id"), dlp.alias("dlp"))
