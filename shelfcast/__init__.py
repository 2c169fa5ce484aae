"""Monthly demand panels and forecasts as Spark DataFrame plans."""

from shelfcast.spec import PanelSpec

__all__ = ["PanelSpec"]
