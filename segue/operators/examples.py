"""From enriched list items to fixed-shape training examples, in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segue.functions.scalars import null_to
from segue.operators.sequence import Lists, training_samples
from segue.schemas import (
    AUDIO_EXAMPLE_REALS, AUDIO_EXAMPLE_TEXTS, ENTITY_TEXTS, HISTORY_REALS, RANK_LABEL, feature_set,
)

# History columns whose name differs from the candidate column they come from.
HISTORY_SOURCES = {"duration_ms_songs": "duration_ms", "artists_followers": "artist_followers"}


def fill_audio(audio: DataFrame, key: str = "track_uri") -> DataFrame:
    """Audio columns under their example names: NULL numbers become 0, codes become text."""
    texts = [null_to(F.col(c.removeprefix("track_")), 0).cast("string").alias(f"{c}_can") for c in AUDIO_EXAMPLE_TEXTS]
    reals = [null_to(F.col(c.removeprefix("track_")).cast("double"), 0.0).alias(f"{c}_can") for c in AUDIO_EXAMPLE_REALS]
    return audio.select(F.col(key).alias(f"{key}_can"), *reals, *texts)


def build_examples(items: Lists, lists: DataFrame, n: int = 5, full_only: bool = True) -> DataFrame:
    """Examples of the `rank` feature set plus `pid` and `pos`.

    `items` holds all candidate columns (`…_can`), audio included: each feature table is joined once per track, best by
    `attach`, and the history arrays take the joined columns along. `lists` holds pid, name and collaborative.
    """
    names = [*ENTITY_TEXTS, *AUDIO_EXAMPLE_TEXTS, *HISTORY_REALS, *AUDIO_EXAMPLE_REALS]
    history = {f"{c}_pl": f"{HISTORY_SOURCES.get(c, c)}_can" for c in names}
    named = lists.select(
        "pid", null_to("name", "").alias("pl_name_src"), F.col("collaborative").alias("pl_collaborative_src")
    )
    samples = training_samples(
        items, history,
        sums={"pl_duration_ms_new": "duration_ms_can"},
        distincts={"num_pl_artists_new": "artist_name_can", "num_pl_albums_new": "album_uri_can"},
        count="num_pl_songs_new", rank=RANK_LABEL, n=n, full_only=full_only, of_list=named,
    )
    return samples.select("pid", "pos", *feature_set("rank"))
