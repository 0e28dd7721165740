"""Main text of web pages: a linear-chain CRF over leaf blocks (operator 7)."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from opslog.llm.html_blocks import Block, blocks

#: Words that page authors give to parts of a page, by kind.
BOILER_NAMES = {
    "nav": "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager tabs toc".split(),
    "header": "header masthead topbar branding logo".split(),
    "footer": "footer copyright legal colophon imprint credits".split(),
    "sidebar": "sidebar aside widget related recommended trending popular rail secondary more".split(),
    "notice": "cookie cookies consent notice banner gdpr alert popup modal warning message overlay".split(),
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion dfp adsense".split(),
    "form": "form newsletter subscribe subscription signup login search contact".split(),
    "share": "share sharing social follow".split(),
    "comments": "comment comments reply replies respond discussion disqus reader thread".split(),
    "meta": "byline author meta tags tag date timestamp".split(),
}
MAIN_NAMES = "article content main post entry story text body page primary".split()
BOILER_TAGS = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}


def features(page: list[Block]) -> list[list[str]]:
    """Ancestor tags, ancestor names and text features of each block."""
    out = []
    for i, block in enumerate(page):
        own = {f"in:{t}" for t in block.tags if t not in ("html", "body")}
        own |= {f"name:{n}" for n in block.names}
        own.add(f"leaf:{next((t for t in reversed(block.tags) if t not in _INLINE_LEAF), 'none')}")
        words = len(block.text.split())
        own.add(f"words:{min(6, words.bit_length())}")
        own.add(f"links:{int(block.linked * 4)}")
        own.add("end:" + ("stop" if re.search(r"[.!?…。][\"'»”)]*$", block.text) else "none"))
        if re.search(r"©|\(c\)|all rights|&copy", block.text, re.I):
            own.add("copyright")
        own.add("place:" + ("first" if i == 0 else "last" if i == len(page) - 1 else "inside"))
        own.add("all")
        out.append(sorted(own))
    return out


_INLINE_LEAF = frozenset("a b i em strong span small u font code".split())


# --- labelled pages -------------------------------------------------------------------

def labelled_pages(count: int, seed: int) -> list[tuple[str, list[str]]]:
    """(html, main blocks) of pages drawn from the ways in which pages are usually built.

    The main text lies in article, main, a named div, a table cell or right in the body; menus,
    headers, footers, side columns, notices, adverts, forms, share bars and reader comments lie
    around or inside it, marked by tags, by names or by both. Words are invented, so the model
    learns structure and not a vocabulary.
    """
    rng = random.Random(seed)

    def phrase(low: int, high: int, stop: bool = True) -> str:
        said = [("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiouäé") for _ in range(rng.randint(1, 4))))
                for _ in range(rng.randint(low, high))]
        return (" ".join(said)).capitalize() + ("." if stop else "")

    def wrap(kind: str, inner: str) -> str:
        name = rng.choice(BOILER_NAMES[kind])
        # A part has its own tag, or a name on a plain element, or both.
        tag = BOILER_TAGS.get(kind)
        named = f' {rng.choice(["class", "id"])}="{rng.choice(["", "site-", "block "])}{name}{rng.choice(["", "-box", " wide"])}"'
        if tag and rng.random() < 0.5:
            return f"<{tag}{named if rng.random() < 0.4 else ''}>{inner}</{tag}>"
        plain = rng.choice(["div", "div", "section", "ul" if kind in ("nav", "share") else "div", "p" if kind == "meta" else "div"])
        return f"<{plain}{named}>{inner}</{plain}>"

    def boiler(kind: str) -> str:
        if kind in ("nav", "share"):
            items = "".join(f"<li><a href='/x'>{phrase(1, 3, False)}</a></li>" for _ in range(rng.randint(2, 8)))
            return wrap(kind, rng.choice([items, f"<ul>{items}</ul>"]))
        if kind == "footer":
            return wrap(kind, rng.choice([f"&copy; {phrase(1, 3, False)} &middot; {phrase(3, 20)}", f"<p>{phrase(3, 15)}</p>",
                                          f"<p>© {phrase(1, 4)}</p><p>{phrase(3, 20)}</p>", phrase(2, 12)]))
        if kind == "form":
            return wrap(kind, f"<label>{phrase(1, 4, False)}</label><input><button>{phrase(1, 2, False)}</button>"
                        + rng.choice(["", f"<p>{phrase(4, 25)}</p>"]))
        if kind == "comments":
            return wrap(kind, "".join(f"<{t}>{phrase(4, 60)}</{t}>" for t in rng.choices(["p", "div", "li"], k=rng.randint(1, 5))))
        if kind == "sidebar":
            return wrap(kind, f"<h3>{phrase(1, 4, False)}</h3>" + "".join(
                rng.choice([f"<li><a href='/y'>{phrase(3, 9, False)}</a></li>", f"<p>{phrase(5, 40)}</p>"]) for _ in range(rng.randint(1, 4))))
        if kind == "header":
            return wrap(kind, rng.choice([f"<h1>{phrase(1, 4, False)}</h1>", f"<a href='/'>{phrase(1, 3, False)}</a>", f"<p>{phrase(2, 8)}</p>"]))
        return wrap(kind, rng.choice([phrase(2, 40), f"<p>{phrase(2, 40)}</p>", f"<p>{phrase(3, 12)}</p><a href='/z'>{phrase(1, 3, False)}</a>"]))

    pages = []
    for _ in range(count):
        main: list[str] = []

        def said(low: int, high: int, stop: bool = True) -> str:
            main.append(phrase(low, high, stop))
            return main[-1]

        body = f"<h1>{said(2, 10, rng.random() < 0.5)}</h1>" if rng.random() < 0.8 else ""
        for _ in range(rng.randint(1, 9)):
            turn = rng.random()
            if turn < 0.04:
                # Articles carry licence lines of their own.
                main.append(rng.choice(["All rights reserved.", f"© {phrase(1, 3)}", f"Copyright (c) {phrase(2, 6)}"]))
                body += f"<p>{main[-1]}</p>"
            elif turn < 0.66:
                body += rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<p>{}</p>"]).format(said(1, 90))
            elif turn < 0.74:
                body += f"<h2>{said(1, 7, False)}</h2>"
            elif turn < 0.8:
                body += "<ul>" + "".join(f"<li>{said(2, 20, rng.random() < 0.5)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>"
            elif turn < 0.84:
                body += f"<blockquote>{said(5, 40)}</blockquote>"
            elif turn < 0.88:
                body += f"<p>{said(3, 25)[:-1]} <a href='/q'>{phrase(1, 3, False)}</a>.</p>"
                main[-1] = main[-1][:-1] + " " + re.search(r"<a href='/q'>([^<]*)</a>\.</p>$", body).group(1) + "."
            else:
                body += boiler(rng.choice(["advert", "share", "sidebar", "notice", "form", "meta", "advert"]))
        if rng.random() < 0.25:
            body += boiler("comments")
        frame = rng.choice(["article", "article", "main", "name", "name", "both", "cell", "bare"])
        if frame in ("article", "main"):
            body = f"<{frame}>{body}</{frame}>"
        elif frame == "name":
            body = f'<div {rng.choice(["class", "id"])}="{rng.choice(MAIN_NAMES)}">{body}</div>'
        elif frame == "both":
            body = f'<main><article class="{rng.choice(MAIN_NAMES)}">{body}</article></main>'
        elif frame == "cell":
            body = f"<table><tr><td>{body}</td></tr></table>"
        before = [boiler(k) for k in rng.sample(["nav", "header", "notice", "advert", "form", "nav"], rng.randint(0, 4))]
        after = [boiler(k) for k in rng.sample(["footer", "sidebar", "comments", "share", "advert", "notice"], rng.randint(0, 4))]
        pages.append((f"<html><head><title>t</title></head><body>{''.join(before)}{body}{''.join(after)}</body></html>", main))
    return pages


def mark(page: list[Block], main: list[str]) -> list[int]:
    """1 for the blocks that are the listed main blocks, in order; 0 for the others."""
    out, at = [], 0
    for block in page:
        hit = at < len(main) and block.text == main[at]
        out.append(int(hit))
        at += hit
    return out


# --- conditional random field ---------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Weights of (feature, label), of (label, next label), and of the first label."""

    place: dict[str, int]
    weight: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(rows), 2))
        for i, row in enumerate(rows):
            known = [self.place[f] for f in row if f in self.place]
            out[i] = self.weight[known].sum(0)
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _marginals(score: np.ndarray, step: np.ndarray, first: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label and neighbour marginals by forward-backward, for padded pages (page, place, label)."""
    n, length, _ = score.shape
    ahead = np.zeros_like(score)
    ahead[:, 0] = score[:, 0] + first
    for t in range(1, length):
        new = _log_sum(ahead[:, t - 1, :, None] + step, 1) + score[:, t]
        ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
    back = np.zeros_like(score)
    for t in range(length - 2, -1, -1):
        new = _log_sum(step[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where(there[:, t + 1, None], new, back[:, t + 1] * 0)
    whole = _log_sum(ahead[:, -1], 1)
    one = np.exp(ahead + back - whole[:, None, None]) * there[..., None]
    both = np.exp(ahead[:, :-1, :, None] + step + (score[:, 1:] + back[:, 1:])[:, :, None, :]
                  - whole[:, None, None, None]) * there[:, 1:, None, None]
    return one, both


def train(pages: list[tuple[str, list[str]]], steps: int = 150, rate: float = 0.1, shrink: float = 1e-4) -> Model:
    """Maximum likelihood with a small L2 penalty, full batches, Adam."""
    rows, truth = [], []
    for source, main in pages:
        found = blocks(source)
        if found:
            rows.append(features(found))
            truth.append(mark(found, main))
    place: dict[str, int] = {}
    for page in rows:
        for row in page:
            for f in row:
                place.setdefault(f, len(place))
    n, length = len(rows), max(map(len, rows))
    there = np.zeros((n, length), bool)
    gold = np.zeros((n, length, 2))
    at, feature = [], []
    for i, (page, marks) in enumerate(zip(rows, truth, strict=True)):
        there[i, :len(page)] = True
        gold[i, np.arange(len(page)), marks] = 1
        for j, row in enumerate(page):
            at += [i * length + j] * len(row)
            feature += [place[f] for f in row]
    at, feature = np.array(at), np.array(feature)
    pairs = gold[:, :-1, :, None] * gold[:, 1:, None, :]
    size = len(place) * 2 + 6
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        weight = theta[:-6].reshape(-1, 2)
        score = np.stack([np.bincount(at, weight[feature, y], n * length) for y in (0, 1)], -1).reshape(n, length, 2)
        one, both = _marginals(score, theta[-6:-2].reshape(2, 2), theta[-2:], there)
        off = (one - gold).reshape(-1, 2)
        grad = np.concatenate([
            np.stack([np.bincount(feature, off[at, y], len(place)) for y in (0, 1)], -1).ravel(),
            (both - pairs).sum((0, 1)).ravel(), (one - gold)[:, 0].sum(0)]) / n + shrink * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(place, theta[:-6].reshape(-1, 2), theta[-6:-2].reshape(2, 2), theta[-2:])


def viterbi(score: np.ndarray, step: np.ndarray, first: np.ndarray) -> list[int]:
    if not len(score):
        return []
    best = score[0] + first
    came = []
    for row in score[1:]:
        every = best[:, None] + step
        came.append(every.argmax(0))
        best = every.max(0) + row
    path = [int(best.argmax())]
    for back in reversed(came):
        path.append(int(back[path[-1]]))
    return path[::-1]


@cache
def default_model(pages: int = 800, seed: int = 3) -> Model:
    return train(labelled_pages(pages, seed))


def main_text(page: str | None, model: Model) -> str:
    found = blocks(page)
    labels = viterbi(model.emissions(features(found)), model.step, model.first)
    return "\n".join(b.text for b, y in zip(found, labels, strict=True) if y)


def extract_pages(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars for every page, repeated rows included.

    Null, empty and text-free pages give an empty text. Nothing is cut from long pages.
    Extra columns are ignored.
    """
    # The model holds a few hundred features, whatever the pages.
    shipped = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, shipped.value) for p in batch["html"].to_pylist()]
            yield pa.record_batch(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")
