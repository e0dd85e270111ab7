"""Layer plans: silver (M06-M10), gold (M11-M17), warehouse build, extras."""
