"""zonalis: small-area health analytics as DataFrame-in, DataFrame-out functions."""

__version__ = "0.1.0"
