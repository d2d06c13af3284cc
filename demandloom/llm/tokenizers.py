"""Public tokenizer files in tasks: read once by the driver, built once per task."""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from dataclasses import dataclass, field
from functools import cached_property

# a single space between other characters: the tokenizers here begin a token at it or drop it,
# and no token reaches across
SEAM = re.compile(r"(?<=\S) (?=\S)")
ENDS = ".,;:!?"  # marks behind a word
LETTER = re.compile(r"[^\W\d_²³¹¼½¾]")
# letters, with apostrophes between them, and what lies between such words
ASCII_WORDS = re.compile(r"[A-Za-z]+(?:'[A-Za-z]+)*|[^A-Za-z]+")
WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[\W\d_]+")
LONE_APOSTROPHE = re.compile(r"(?<![^\W\d_])'|'(?![^\W\d_])")


@dataclass(frozen=True)
class TokenizerFile:
    """A tokenizer file's content (a few megabytes), which travels to the tasks."""

    name: str
    content: bytes = field(repr=False)
    special_as_text: bool = False
    _model: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        # the built object does not travel: its pickled form forgets settings
        return self.name, self.content, self.special_as_text

    def __setstate__(self, state):
        for key, value in zip(("name", "content", "special_as_text", "_model"), (*state, [])):
            object.__setattr__(self, key, value)

    @classmethod
    def read(cls, path: str, special_as_text: bool = False) -> TokenizerFile:
        with open(path, "rb") as f:
            return cls(os.path.basename(path), f.read(), special_as_text)

    @property
    def is_pieces(self) -> bool:
        return self.name.endswith(".model")

    @property
    def version(self) -> str:
        """Digest of all that decides how a text is encoded."""
        from importlib.metadata import version

        library = "sentencepiece" if self.is_pieces else "tokenizers"
        told = f"{library} {version(library)} special_as_text={self.special_as_text} ".encode()
        return hashlib.sha256(told + self.content).hexdigest()

    @property
    def folds_space(self) -> bool:
        """Whether the tokenizer itself turns each run of white space into one space."""
        if self.is_pieces:
            return False
        normalizer = json.loads(self.content).get("normalizer") or {}
        steps = normalizer.get("normalizers", [normalizer])
        return any(
            s.get("type") == "Replace" and s["pattern"].get("Regex") == r"\s+" and s["content"] == " " for s in steps
        )

    def built(self):
        """The library's object."""
        if not self._model:
            self._model.append(self._build())
        return self._model[0]

    def _build(self):
        # Spark's tasks are the parallelism
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if self.is_pieces:
            import sentencepiece

            return sentencepiece.SentencePieceProcessor(model_proto=self.content)
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(self.content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = self.special_as_text
        return tokenizer

    def encode(self, texts: list[str]) -> list:
        """Per text something with a length; token ids are in ``ids_of`` it."""
        if self.is_pieces:
            return self.built().encode(texts, num_threads=1)
        return self.built().encode_batch_fast(texts, add_special_tokens=False)

    @cached_property
    def cuts_at_seams(self) -> bool:
        """Whether the parts of a text between its seams are encoded as in the text.

        A pieces' model must know no piece with a space behind another character. Others must
        split texts by a pattern that leaves spaces out or puts them at the start of words.
        """
        if self.is_pieces:
            model = self.built()
            pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
            return not any(a != "▁" and b == "▁" for p in pieces for a, b in zip(p, p[1:]))
        pre = json.loads(self.content).get("pre_tokenizer") or {}
        return self._apart is not None or (pre.get("type") == "ByteLevel" and pre.get("use_regex", True))

    @cached_property
    def marks_apart(self) -> bool:
        """Whether marks behind a letter are encoded apart from the word."""
        if not self.cuts_at_seams:
            return False
        if not self.is_pieces:
            return True
        model = self.built()
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        return not any(b in ENDS and LETTER.match(a) for p in pieces for a, b in zip(p, p[1:]))

    def seams(self, text: str) -> list[str]:
        """The parts of a text between its seams."""
        return SEAM.split(text) if self.cuts_at_seams else [text]

    def at_seams(self, text: str) -> list[str]:
        """The text in parts whose encodings, one behind the other, are that of the text."""
        first, *rest = self.seams(text)
        # a sentencepiece model puts the space before a part itself
        return [first, *(rest if self.is_pieces else [" " + part for part in rest])]

    @cached_property
    def _apart(self) -> tuple[str, ...] | None:
        """Strings of special tokens, where the tokenizer takes runs of letters for words of their
        own and drops white space; else None."""
        if self.is_pieces:
            return None
        told = json.loads(self.content)
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if not any(
            s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
            and r"[\p{L}]+" in s["pattern"].get("Regex", "").split("|") for s in steps
        ):
            return None
        return tuple(t["content"] for t in told.get("added_tokens", []))

    def words(self, text: str) -> list[str]:
        """As ``at_seams``, in smaller parts where the tokenizer allows: words and what lies
        between them.

        Not so where one could change the other: special tokens hold both, apostrophes that begin
        a word may belong to it or not, and characters may be composed across a cut.
        """
        special = self._apart
        if (
            special is None or any(t in text for t in special) or "'" in text and LONE_APOSTROPHE.search(text)
            or not unicodedata.is_normalized("NFC", text) or "\u03a3" in text
        ):
            return self.at_seams(text)
        return (ASCII_WORDS if text.isascii() else WORDS).findall(text) or [""]

    def ids_of(self, encoded) -> list[int]:
        return encoded if self.is_pieces else encoded.ids

    def token_bytes(self) -> list[bytes]:
        """The bytes that each token id stands for."""
        model = self.built()
        if self.is_pieces:
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            return [
                bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        byte_of = _byte_of()
        table = [b""] * model.get_vocab_size()
        for token, i in model.get_vocab().items():
            known = all(c in byte_of for c in token)
            table[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        return table


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in
    order, as the characters from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}
