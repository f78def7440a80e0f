"""Downloads of streams, sections and stations, with or without geometry."""

from freshet.sources.layers import export_csv, export_layer

KINDS = {"streams": "Stream", "sections": "Ecosection", "stations": "WSC"}


def download(df, what, folder, region="Whole Province", form="csv", order=None, date=None):
    """Write one download and give its path; section files carry no region in their name."""
    region = "Whole Province" if what == "sections" else region
    if form == "csv":
        return export_csv(df, folder, KINDS[what], region, order, date)
    return export_layer(df, folder, KINDS[what], region, date)
