"""Queries over the derived inputs, grouped by subject."""

from spotweave.plans.barcodes import barcodes
from spotweave.plans.basecalls import basecalls
from spotweave.plans.cells import cells
from spotweave.plans.files import files
from spotweave.plans.geometry import geometry
from spotweave.plans.pixels import pixels
from spotweave.plans.runs import runs

REGISTRIES = [cells, pixels, basecalls, barcodes, geometry, files, runs]
