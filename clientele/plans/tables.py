"""A set of tables by name."""

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame


class Tables:
    """Tables as attributes, each planned when first asked for.

    A view that needs two of five tables does not pay for the analysis of the others.
    """

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers = makers

    def __getattr__(self, name: str) -> DataFrame:
        try:
            made = self.__dict__["_makers"][name]()
        except KeyError:
            raise AttributeError(name) from None
        self.__dict__[name] = made
        return made

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    @staticmethod
    def of(**frames: DataFrame) -> "Tables":
        return Tables(**{name: lambda df=df: df for name, df in frames.items()})
