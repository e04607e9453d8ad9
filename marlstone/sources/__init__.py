"""Tables: where their rows come from and go to."""
