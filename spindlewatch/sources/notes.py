"""Numbered notes: small facts that several processes agree on without a clock or a lock."""

from spindlewatch.sources.tables import names_in, read_note, remove, write_note


class Notes:
    """Texts numbered 0, 1, 2, ... under ``path``; each number is given once and for all.

    Of several writers of the same number one succeeds and the others get FileExistsError, on stores that create
    files exclusively. So who adds the number behind the one that was looked at knows that nobody came between.
    With ``keep`` only so many of the newest notes stay, and finding the last one lists a handful of names.
    """

    def __init__(self, spark, path, keep=None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep

    def _note(self, number):
        return f"{self.path}/note={number:012d}"

    def last(self):
        """The last number, or -1."""
        return max((int(n.split("=")[1]) for n in names_in(self.spark, self.path) if n.startswith("note=")), default=-1)

    def text(self, number):
        """The text of a number, or None."""
        return read_note(self.spark, self._note(number)) if number >= 0 else None

    def add(self, number, text):
        write_note(self.spark, self._note(number), text, replace=False)
        if self.keep:
            remove(self.spark, self._note(number - self.keep))

    def replace(self, number, text):
        """Change a note of one's own."""
        write_note(self.spark, self._note(number), text)
