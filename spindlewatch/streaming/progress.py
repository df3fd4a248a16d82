"""How far a reader of numbered batches has come."""

from spindlewatch.sources.notes import Notes


class Progress:
    """Steps 0, 1, 2, ... under ``path``, each with the last batch that belongs to it; the last two steps stay.

    A step is noted once and for all: of two readers that note the same one, one gets FileExistsError.
    """

    def __init__(self, spark, path):
        self.notes = Notes(spark, path, keep=2)

    def last(self):
        """The last step, or -1."""
        return self.notes.last()

    def upto(self, step):
        """The last batch of a step, or None if the step was not noted; before the first one it is None, too."""
        text = self.notes.text(step)
        return int(text) if text else None

    def note(self, step, upto):
        self.notes.add(step, str(upto))
