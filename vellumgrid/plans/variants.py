"""The five rule sets of the one layout pipeline, as parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Names and numbers that results depend on.
OCR_LABELS = ("Text", "Section-header", "Caption", "Footnote", "List-item", "Page-footer", "Page-header", "Table-of-contents", "Handwriting",
    "Text-inline-math", "Formula")
SKIP_LABELS = ("Picture", "Figure", "Table", "Form")
SINGLE_BLOCK_LABELS = ("Section-header", "Page-header", "Caption", "Footnote")
ALIASES_BC = {
    "SectionHeader": "Section-header", "PageHeader": "Page-header", "PageFooter": "Page-footer", "ListItem": "List-item",
        "TableOfContents": "Table-of-contents", "InlineMath": "Text-inline-math",
    "TextInlineMath": "Text-inline-math", "Header": "Page-header", "Footer": "Page-footer", "Heading": "Section-header", "Title": "Section-header",
        "Handwritten": "Handwriting",
}
ALIASES_D = ALIASES_BC | {
    "section_header": "Section-header", "page_header": "Page-header", "page_footer": "Page-footer", "list_item": "List-item",
        "table_of_contents": "Table-of-contents", "inline_math": "Text-inline-math",
    "text_inline_math": "Text-inline-math", "handwriting": "Handwriting", "figure_caption": "Caption", "FigureCaption": "Caption",
        "table_caption": "Caption", "TableCaption": "Caption",
    "paragraph": "Text", "Paragraph": "Text", "body": "Text", "Body": "Text",
}
SEGMENT_COLOURS = ("#E63946", "#2196F3", "#4CAF50", "#FF9800", "#9C27B0", "#00BCD4", "#FF5722", "#8BC34A", "#3F51B5", "#F06292")
LABEL_COLOURS = {
    "Page-header": "#1565C0", "Section-header": "#C62828", "Text": "#2E7D32", "Caption": "#6A1B9A", "Footnote": "#4E342E", "Page-footer": "#37474F", "Table": "#E65100",
    "Picture": "#00838F", "Figure": "#00695C", "List-item": "#558B2F", "Handwriting": "#AD1457", "Form": "#FF6F00", "Table-of-contents": "#0277BD",
}
DEFAULT_COLOUR = "#9E9E9E"


@dataclass(frozen=True)
class Variant:
    """Thresholds of a rule set; None switches a rule off."""

    name: str
    dpi: int = 300
    confidence: float | None = 0.25
    single_char: float | None = 0.50
    noise_height: float = 8
    noise_width: float = 15
    line_height: float = 8
    line_width: float = 15
    font: float = 0.85
    aliases: dict | None = None
    iou: float | None = None
    options: int = 2
    abort_on_lost_text: bool = False
    clears_empty: bool = False


S = Variant("s", confidence=0.22, single_char=0.45, noise_height=12, line_height=5, line_width=5, font=0.9, options=3, abort_on_lost_text=True, clears_empty=True)
A = Variant("a", dpi=200, noise_height=10, line_height=5, line_width=5, font=0.9, options=3, abort_on_lost_text=True, clears_empty=True)
B = Variant("b", confidence=None, single_char=None, line_height=0, line_width=0, aliases=ALIASES_BC)
C = Variant("c", aliases=ALIASES_BC)
D = Variant("d", aliases=ALIASES_D, iou=0.45)
VARIANTS = {v.name: v for v in (S, A, B, C, D)}


@dataclass(frozen=True)
class Page:
    """A raster page's size in pixels; points follow from the resolution."""

    width: float = 2400.0
    height: float = 1800.0


@dataclass(frozen=True)
class Columns:
    """How columns and stories are told apart (pixels, or shares of the page)."""

    narrow: float = 0.28
    gap: float = 20.0
    merge: float = 20.0
    bucket: float = 4.0
    near_zero: int = 1
    margin: float = 0.08
    column: float = 0.15
    header_zone: float = 0.05
    header_width: float = 0.65
    header_top: float = 0.12
    story_gap: float = 30.0
    story_span: float = 200.0
    photo_gap: float = 250.0


REGION_OVERLAP = 0.05
ROW_BUCKET = 15
REGION_WIDTH, REGION_HEIGHT = 40.0, 15.0
BUDGET = 1.15
