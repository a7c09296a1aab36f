"""Listing cards out of stored HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.config import DEFAULTS, Settings

# Which classes mark which part of a card.
CARD_CLASS = re.compile("listing-card|relative")
TITLE_CLASS = re.compile("title")
PLACE_CLASS = re.compile("location|text-sm")
FEATURE_CLASS = re.compile("feature|label|text-sm")
PRICE_MARK = "KSh"
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
}

CARD_SCHEMA = (
    "page_id long, position int, title string, price string, "
    "location string, url string, card_bathrooms string"
)


def listing_cards(pages: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """One row per card with a title and a price, from columns page_id and html.

    Cards nest and their parts are told apart by tag and class, so pages are read
    with the standard HTML parser, batch by batch, each page whole.
    """
    base, default_place = s.site_base_url, s.default_location

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [field.split()[0] for field in CARD_SCHEMA.split(", ")]
        for batch in batches:
            rows = [
                (page_id, i, *card)
                for page_id, html in zip(batch["page_id"], batch["html"])
                for i, card in enumerate(cards_of_page(html, base, default_place))
            ]
            out = pd.DataFrame(rows, columns=columns)
            # As text: a page may hold a number that no integer column can.
            out["card_bathrooms"] = [None if n is None else str(n) for _, *_, n in rows]
            yield out

    # Pages that cannot hold a card never reach Python.
    hopeful = pages.select("page_id", "html").filter(
        F.col("html").rlike(CARD_CLASS.pattern) & F.contains("html", F.lit(PRICE_MARK))
    )
    return hopeful.mapInPandas(extract, CARD_SCHEMA).withColumn(
        "card_bathrooms", F.col("card_bathrooms").try_cast("int")
    )


class _Card:
    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.found: dict[str, list[str]] = {}
        self.price: str | None = None
        self.href: str | None = None
        self.features: list[list[str]] = []


class _CardParser(HTMLParser):
    """Keeps the open tags; text goes to every open part that wants it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[list[str]]]] = []
        self.open_cards: list[_Card] = []
        self.cards: list[_Card] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        attributes = dict(attrs)
        classes = (attributes.get("class") or "").split()

        def marked(pattern: re.Pattern) -> bool:
            return any(pattern.search(c) for c in classes)

        sinks: list[list[str]] = []
        for card in self.open_cards:
            for part, wanted in (
                ("h2", tag == "h2"),
                ("titled", tag == "a" and marked(TITLE_CLASS)),
                ("place", tag == "div" and marked(PLACE_CLASS)),
            ):
                if wanted and part not in card.found:
                    sinks.append(card.found.setdefault(part, []))
            if tag == "span" and marked(FEATURE_CLASS):
                card.features.append([])
                sinks.append(card.features[-1])
            if tag == "a" and card.href is None and "href" in attributes:
                card.href = attributes["href"] or ""
        if tag in VOID_TAGS:
            return
        self.stack.append((tag, sinks))
        if tag == "div" and marked(CARD_CLASS):
            card = _Card(len(self.stack))
            self.open_cards.append(card)
            self.cards.append(card)

    def handle_endtag(self, tag: str) -> None:
        # A stray end tag is ignored; an unclosed tag ends with its parent.
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
        self.open_cards = [c for c in self.open_cards if c.depth <= len(self.stack)]

    def handle_data(self, data: str) -> None:
        for card in self.open_cards:
            if card.price is None and PRICE_MARK in data:
                card.price = data.strip()
        for _, sinks in self.stack:
            for sink in sinks:
                sink.append(data)


def cards_of_page(
    html: str | None, base_url: str, default_place: str
) -> Iterator[tuple[str, str, str, str, int | None]]:
    if not html:
        return
    parser = _CardParser()
    parser.feed(html)
    parser.close()
    for card in parser.cards:
        title = card.found.get("h2", card.found.get("titled"))
        if title is None or card.price is None:
            continue
        place = card.found.get("place")
        yield (
            _joined(title),
            card.price,
            default_place if place is None else _joined(place),
            _absolute(card.href, base_url),
            bathrooms_of(card.features),
        )


def _joined(texts: list[str]) -> str:
    return "".join(t.strip() for t in texts)


def _absolute(href: str | None, base_url: str) -> str:
    if href is None:
        return ""
    return href if href.startswith("http") else base_url + href


def bathrooms_of(features: list[list[str]]) -> int | None:
    """The number in the first feature that speaks of a bath."""
    for texts in features:
        text = "".join(texts).lower()
        if "bath" in text:
            number = re.search(r"\d+", text)
            return int(number.group()) if number else None
    return None
