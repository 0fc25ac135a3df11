"""Point-of-sale analytics as Spark DataFrame operators."""

from counterfoil.model import Pos

__all__ = ["Pos"]
