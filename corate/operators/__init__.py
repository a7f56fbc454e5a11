"""DataFrame operators. No action runs inside them except the explicit,
bounded size checks documented where they occur."""
