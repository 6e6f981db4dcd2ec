"""Mailing-list analytics on Spark: parse, pseudonymise, analyse and stream e-mail archives."""

__version__ = "0.1.0"
