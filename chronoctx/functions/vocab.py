"""Controlled vocabularies of the dataset catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Availability of a distribution (DCAT-AP vocabulary).
AVAILABILITY = (
    "http://data.europa.eu/r5r/availability/temporary",
    "http://data.europa.eu/r5r/availability/experimental",
    "http://data.europa.eu/r5r/availability/available",
    "http://data.europa.eu/r5r/availability/stable",
)

# Resource formats as name | description | mime type.
RESOURCE_FORMATS = """\
ArcGIS Map Preview | ArcGIS Map Preview | ArcGIS Map Preview
ArcGIS Map Service | ArcGIS Map Service | ArcGIS Map Service
ArcGIS Online Map | ArcGIS Online Map | ArcGIS Online Map
Atom Feed | Atom Feed | application/atom+xml
BIN | Binary Data | application/octet-stream
BMP | Bitmap Image File | image/x-ms-bmp
CSV | Comma Separated Values File | text/csv
DCR | Adobe Shockwave format | application/x-director
dBase | dBase Database | application/x-dbf
DOC | Word Document | application/msword
DOCM | Word OOXML - Macro Enabled | application/vnd.ms-word.document.macroEnabled.12
DOCX | Word OOXML Document | application/vnd.openxmlformats-officedocument.wordprocessingml.document
DOTM | Word OOXML Template - Macro Enabled | application/vnd.ms-word.template.macroEnabled.12
DOTX | Word OOXML - Template | application/vnd.openxmlformats-officedocument.wordprocessingml.template
Esri REST | Esri Rest API Endpoint | Esri REST
EXE | Windows Executable Program | application/x-msdownload
E00 | ARC/INFO interchange file format | application/x-e00
GeoJSON | Geographic JavaScript Object Notation | application/geo+json
GIF | GIF Image File | image/gif
GTFS | General Transit Feed Specification |
GZ | Gzip File | application/gzip
HTML | Web Page | text/html
ICS | iCalendar | text/calendar
JPEG | JPG Image File | image/jpeg
JS | JavaScript | application/x-javascript
JSON | JavaScript Object Notation | application/json
JSON_LD | JavaScript Object Notation Linked Data | application/ld+json
KML | KML File | application/vnd.google-earth.kml+xml
KMZ | KMZ File | application/vnd.google-earth.kmz+xml
MDB | Access Database | application/x-msaccess
MOP | MOPAC Input format | chemical/x-mopac-input
MP3 | MPEG-1 Audio Layer-3 | audio/mpeg
MP4 | MPEG Video File | video/mp4
MrSID | MrSID | image/x-mrsid
MXD | ESRI ArcGIS project file | application/x-mxd
NetCDF | NetCDF File | application/netcdf
N3 | N3 Triples | application/x-n3
OGG | Ogg Vorbis Audio File | audio/ogg
ODB | OpenDocument Database | application/vnd.oasis.opendocument.database
ODC | OpenDocument Chart | application/vnd.oasis.opendocument.chart
ODF | OpenDocument Math Formula | application/vnd.oasis.opendocument.formula
ODG | OpenDocument Image | application/vnd.oasis.opendocument.graphics
OWL | Web Ontology Language | application/owl+xml
ODP | OpenDocument Presentation | application/vnd.oasis.opendocument.presentation
ODS | OpenDocument Spreadsheet | application/vnd.oasis.opendocument.spreadsheet
ODT | OpenDocument Text | application/vnd.oasis.opendocument.text
PDF | PDF File | application/pdf
Perl | Perl Script | text/x-perl
PNG | PNG Image File | image/png
POTM | PowerPoint Open XML - Macro-Enabled Template | application/vnd.ms-powerpoint.template.macroEnabled.12
POTX | PowerPoint OOXML Presentation - Template | application/vnd.openxmlformats-officedocument.presentationml.template
PPAM | PowerPoint Open XML - Macro-Enabled Add-In | application/vnd.ms-powerpoint.addin.macroEnabled.12
PPT | Powerpoint Presentation | application/vnd.ms-powerpoint
PPTM | PowerPoint Open XML - Macro-Enabled | application/vnd.ms-powerpoint.presentation.macroEnabled.12
PPTX | Powerpoint OOXML Presentation | application/vnd.openxmlformats-officedocument.presentationml.presentation
PPSM | PowerPoint Open XML - Macro-Enabled Slide Show | application/vnd.ms-powerpoint.slideshow.macroEnabled.12
PPSX | PowerPoint Open XML - Slide Show | application/vnd.openxmlformats-officedocument.presentationml.slideshow
QGIS | QGIS File | application/x-qgis
RAR | RAR Compressed File | application/rar
RDF | RDF | application/rdf+xml
RSS | RSS feed | application/rss+xml
SHP | Shapefile |
SPARQL | SPARQL end-point | application/sparql-results+xml
SVG | SVG vector image | image/svg+xml
TAR | TAR Compressed File | application/x-tar
TIFF | TIFF Image File | image/tiff
TORRENT | Torrent | application/x-bittorrent
TSV | Tab Separated Values File | text/tab-separated-values
TXT | Text File | text/plain
WAV | Wave file | audio/x-wav
WCS | Web Coverage Service | wcs
WebM | WEBM video | video/webm
WFS | Web Feature Service |
WMS | Web Mapping Service | WMS
WMTS | Web Map Tile Service |
XLAM | Excel OOXML Spreadsheet - Macro-Enabled Add-In | application/vnd.ms-excel.addin.macroEnabled.12
XLS | Excel Document | application/vnd.ms-excel
XLSB | Excel OOXML Spreadsheet - Binary Workbook | application/vnd.ms-excel.sheet.binary.macroEnabled.12
XLSM | Excel OOXML Spreadsheet - Macro-Enabled | application/vnd.ms-excel.sheet.macroEnabled.12
XLSX | Excel OOXML Spreadsheet | application/vnd.openxmlformats-officedocument.spreadsheetml.sheet
XLTM | Excel OOXML Spreadsheet - Macro-Enabled Template | application/vnd.ms-excel.template.macroEnabled.12
XLTX | Excel OOXML Spreadsheet - Template | application/vnd.openxmlformats-officedocument.spreadsheetml.template
XML | XML File | application/xml
XSLT | Extensible Stylesheet Language Transformations | application/xslt+xml
XYZ | XYZ Chemical File | chemical/x-xyz
ZIP | Zip File | application/zip
"""


def format_rows() -> list[tuple[str, str, str | None]]:
    rows = []
    for line in RESOURCE_FORMATS.splitlines():
        name, description, mime = (part.strip() for part in line.split("|"))
        rows.append((name, description, mime or None))
    return rows


def resource_formats(spark: SparkSession) -> DataFrame:
    """The format lookup table (86 rows, so a fixed-size broadcast side)."""
    return spark.createDataFrame(format_rows(), "format string, description string, mimetype string")


def vocabulary(spark: SparkSession) -> DataFrame:
    """Allowed values per field; formats without a mime type are left out."""
    rows = [("availability", uri) for uri in AVAILABILITY]
    known = [row for row in format_rows() if row[2]]
    rows += [("format", name) for name, _, _ in known]
    rows += [("mimetype", mime) for mime in sorted({mime for _, _, mime in known})]
    return spark.createDataFrame(rows, "field string, value string")
