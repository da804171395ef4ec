"""User-profile tagging on Spark: rules in, tagged profiles and audiences out."""

from tagloom.session import build_session

__all__ = ["build_session"]
