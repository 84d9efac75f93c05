"""Schemas: list slices, feature tables, and the named sets of example features."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _TEXT, _REAL = T.LongType(), T.StringType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The fields of a track in the source files.
TRACK_FIELDS = ["pos", "artist_name", "track_uri", "artist_uri", "track_name", "album_uri", "duration_ms", "album_name"]

TRACK = _struct(
    pos=_LONG, artist_name=_TEXT, track_uri=_TEXT, artist_uri=_TEXT,
    track_name=_TEXT, album_uri=_TEXT, duration_ms=_LONG, album_name=_TEXT,
)
PLAYLIST = T.StructType(
    _struct(
        pid=_LONG, name=_TEXT, description=_TEXT, modified_at=_LONG, num_artists=_LONG, num_albums=_LONG,
        num_tracks=_LONG, num_followers=_LONG, num_edits=_LONG, duration_ms=_LONG, collaborative=_TEXT,
    ).fields
    + [T.StructField("tracks", T.ArrayType(TRACK))]
)
SLICE = T.StructType(
    [
        T.StructField("info", _struct(slice=_TEXT, version=_TEXT, description=_TEXT, license=_TEXT, generated_on=_TEXT)),
        T.StructField("playlists", T.ArrayType(PLAYLIST)),
    ]
)

# Columns of the audio and artist feature tables.
AUDIO_REALS = [
    "danceability", "energy", "key", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness",
    "valence", "tempo",
]
AUDIO_LONGS = ["mode", "duration_ms", "time_signature", "track_pop"]
AUDIO_TEXTS = ["type", "id", "uri", "track_href", "analysis_url"]

AUDIO_FEATURES = T.StructType(
    [T.StructField(n, _REAL) for n in AUDIO_REALS]
    + [T.StructField(n, _LONG) for n in AUDIO_LONGS]
    + [T.StructField(n, _TEXT) for n in AUDIO_TEXTS]
    + [T.StructField("track_uri", _TEXT, nullable=False)]
)
ARTIST_FEATURES = _struct(artist_pop=_LONG, genres=_TEXT, followers=_LONG, artist_uri=_TEXT)

# Names of the example features.
ENTITY_TEXTS = ["track_uri", "track_name", "artist_uri", "artist_name", "album_uri", "album_name", "artist_genres"]
AUDIO_EXAMPLE_TEXTS = ["track_key", "track_mode", "track_time_signature"]
AUDIO_EXAMPLE_REALS = [
    "track_danceability", "track_energy", "track_loudness", "track_speechiness", "track_acousticness",
    "track_instrumentalness", "track_liveness", "track_valence", "track_tempo",
]
CANDIDATE_REALS = ["duration_ms", "track_pop", "artist_pop", "artist_followers"]
HISTORY_REALS = ["duration_ms_songs", "track_pop", "artist_pop", "artists_followers"]
PLAYLIST_TEXTS = ["pl_name_src", "pl_collaborative_src"]
PLAYLIST_REALS = ["pl_duration_ms_new", "num_pl_songs_new", "num_pl_artists_new", "num_pl_albums_new"]
RANK_LABEL = "candidate_rank"

# A feature set maps a column to (kind, is it a list of N values).
FeatureSet = dict[str, tuple[str, bool]]


def _features(texts: list[str], reals: list[str], suffix: str, listed: bool) -> FeatureSet:
    named = {f"{n}{suffix}": ("string", listed) for n in texts}
    return {**named, **{f"{n}{suffix}": ("float", listed) for n in reals}}


def candidate_features() -> FeatureSet:
    return _features(ENTITY_TEXTS + AUDIO_EXAMPLE_TEXTS, CANDIDATE_REALS + AUDIO_EXAMPLE_REALS, "_can", False)


def playlist_features() -> FeatureSet:
    return _features(PLAYLIST_TEXTS, PLAYLIST_REALS, "", False)


def history_features() -> FeatureSet:
    return _features(ENTITY_TEXTS + AUDIO_EXAMPLE_TEXTS, HISTORY_REALS + AUDIO_EXAMPLE_REALS, "_pl", True)


def audio_ranker_features() -> FeatureSet:
    return {
        "pl_name_src": ("string", False),
        **_features(["track_name", *AUDIO_EXAMPLE_TEXTS], AUDIO_EXAMPLE_REALS, "_pl", True),
        **_features(["track_name", "artist_genres", *AUDIO_EXAMPLE_TEXTS], AUDIO_EXAMPLE_REALS, "_can", False),
        RANK_LABEL: ("float", True),
    }


def feature_set(name: str) -> FeatureSet:
    """The features of a named example kind."""
    towers = {**candidate_features(), **playlist_features(), **history_features()}
    sets = {
        "candidate": candidate_features(),
        "query": {**playlist_features(), **history_features()},
        "towers": towers,
        "rank": {**towers, RANK_LABEL: ("float", True)},
        "audio-rank": audio_ranker_features(),
        "lw-audio-rank": audio_ranker_features(),
    }
    return sets[name]


def example_type(features: FeatureSet) -> T.StructType:
    kinds = {"string": T.StringType(), "float": T.FloatType(), "int": T.LongType()}
    return T.StructType(
        [T.StructField(n, T.ArrayType(kinds[k]) if listed else kinds[k]) for n, (k, listed) in features.items()]
    )
