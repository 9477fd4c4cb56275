"""The registered queries."""

from vocalake.queries import corpus, lines, media, requests, runs, text  # noqa: F401
