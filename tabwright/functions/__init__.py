from tabwright.functions import cells, csvtext, dates

__all__ = ["cells", "csvtext", "dates"]
