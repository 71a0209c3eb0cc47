"""``python -m cartwheel <job> ...`` — same as ``python -m cartwheel.cli``."""

from cartwheel.cli import main

main()
